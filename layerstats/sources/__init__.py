from layerstats.sources.delimited import SOURCE_FILE, ingest_csv
from layerstats.sources.layers import BRONZE, GOLD, SILVER, LayerConfig, publish, publish_all, read_layer, recover, stage
from layerstats.sources.shared import remove_dir, shared_dir

__all__ = [
    "BRONZE",
    "GOLD",
    "SILVER",
    "SOURCE_FILE",
    "LayerConfig",
    "ingest_csv",
    "publish",
    "publish_all",
    "read_layer",
    "recover",
    "remove_dir",
    "shared_dir",
    "stage",
]
