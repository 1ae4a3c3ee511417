"""No streaming operator is in the inventory; every job is batch."""
