"""Where rows come from: test tables, files and message topics."""
