"""Where rows, listings, configs and triggers come from, and where results go."""
