"""Job-posting analytics on Spark: read, clean, load, search, analyse, ingest."""

from hirelens.operators.analyses import ANALYSES, market_cube, run
from hirelens.operators.labels import label_sentences
from hirelens.operators.quality import violations
from hirelens.operators.search import search
from hirelens.plans.clean import clean_postings
from hirelens.plans.daily import ingest_day
from hirelens.plans.star import build_star, load_star, read_star
from hirelens.sources.blocks import read_blocks
from hirelens.sources.flat import flat_export, read_flat_csv, write_flat_csv
from hirelens.streaming.ingest import ingest_stream

__all__ = [
    "ANALYSES", "build_star", "clean_postings", "flat_export", "ingest_day", "ingest_stream", "label_sentences",
    "load_star", "market_cube", "read_blocks", "read_flat_csv", "read_star", "run", "search", "violations",
    "write_flat_csv",
]
