"""Reading releases, registries and catalogues; writing tables."""
