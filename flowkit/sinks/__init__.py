"""Writers for text, CSV, tables and message streams."""
