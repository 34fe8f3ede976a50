"""Named datasets of the bronze, silver and gold layers and the extracts."""
