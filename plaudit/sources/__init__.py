"""Raw files, typed tables and result sets."""
