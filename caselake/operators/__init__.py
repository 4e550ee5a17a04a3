"""DataFrame-to-DataFrame operators: lazy, no session creation, no collecting."""
