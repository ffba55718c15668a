"""Helpers shared by the training-data operators."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.session import ensure_checkpoint_dir

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: The same as a Java regular expression of runs.
BLANK_RUN = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Cut lineage: write the rows to the folder in ``spark.checkpoint.dir`` and read them back."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text of a row; a null text is an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


class Remembered(dict):
    """Results of ``make`` by word, in two generations so that common words outlive a full memory."""

    def __init__(self, size: int = 500_000, longest: int = 64) -> None:
        super().__init__()
        self.size, self.longest, self.old = size, longest, {}

    def make(self, word):
        raise NotImplementedError

    def __missing__(self, word):
        found = self.old.get(word)
        if found is None:
            found = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found
