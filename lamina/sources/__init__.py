"""Where rows come from and go to: CSV folders, catalog tables, connectors."""
