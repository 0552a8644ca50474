"""Where packets come from, and where shared intermediate tables are kept."""
