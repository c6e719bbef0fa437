"""Jobs that read and write warehouse tables."""
