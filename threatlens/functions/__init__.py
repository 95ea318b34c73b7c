"""threatlens package."""
