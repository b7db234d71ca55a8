"""The operators: cleaning, star schema, features, segments, churn, explanation."""
