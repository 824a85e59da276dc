"""Every operator as a registered query, with an independent SQL oracle."""
