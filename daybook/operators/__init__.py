"""DataFrame to DataFrame transformations; none of them runs an action."""
