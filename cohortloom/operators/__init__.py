"""DataFrame-to-DataFrame operators the registries are composed from."""
