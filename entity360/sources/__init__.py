from entity360.sources.loader import SchemaMismatch, conform_source, load_source, load_sources
from entity360.sources.schemas import SOURCE_SCHEMAS

__all__ = ["SOURCE_SCHEMAS", "SchemaMismatch", "conform_source", "load_source", "load_sources"]
