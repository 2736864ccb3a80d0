"""File sources, control-driven ingestion and the driver-table adapter."""
