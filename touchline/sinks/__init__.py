from touchline.sinks.stream import start_append
from touchline.sinks.tables import read_curated, read_transformed, write_curated, write_transformed

__all__ = ["read_curated", "read_transformed", "start_append", "write_curated", "write_transformed"]
