"""The registered queries: operators bound to the provided tables, and their SQL."""
