"""DataFrame -> DataFrame steps. None of them runs an action."""
