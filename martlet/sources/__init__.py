from martlet.sources.catalog import Catalog, fixture_catalog  # noqa: F401
