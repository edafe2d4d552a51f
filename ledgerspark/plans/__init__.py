"""Query registry, section runner, typed silver layer and oracle SQL."""
