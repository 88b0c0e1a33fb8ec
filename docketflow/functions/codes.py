"""Status codes that count as an exit. The codes are opaque text, '196' included."""

# Exit codes of a case's own events.
EXIT_CODES = (
    "196", "ACU", "ARC", "CDM", "DES", "DEV", "DFD", "DIC",
    "ETR", "FII", "HDT", "REB", "SCA", "SOB", "PRE",
)

# Codes of events and reassignments of the cases derived from it.
CHILD_CODES = ("ETO",)

# What stands in place of an event id.
NO_EXIT = -2
SEVERAL_EXITS = -3
