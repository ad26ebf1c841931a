"""Job plans: zoom groups, and whole runs from sources to archives."""
