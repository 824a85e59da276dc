"""The two results: the feature matrix and the engagement label."""
