"""Company-site intelligence on Spark: captured pages and stored answers in, one profile per site out."""
