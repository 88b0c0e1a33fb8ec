"""Chamber statistics and the control of their runs."""
