"""Where rows come from and go to: streams, tables, catalog, and the derived feed."""
