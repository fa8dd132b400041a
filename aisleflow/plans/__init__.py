"""Plans: end-to-end jobs, model fits, and the registry of named queries
with their SQL re-statements."""
