"""Writers of the lake."""
