"""Sources and sinks: CSV and parquet in, parquet and CSV out."""

from seqframe.sources.csv import read_headered_csv, read_labelled_csv
from seqframe.sources.parquet import read_frame, read_vocab
from seqframe.sources.sinks import write_csv, write_frame, write_vocab

__all__ = [
    "read_frame",
    "read_headered_csv",
    "read_labelled_csv",
    "read_vocab",
    "write_csv",
    "write_frame",
    "write_vocab",
]
