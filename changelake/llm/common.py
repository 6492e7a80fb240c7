"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from changelake.workdir import fresh
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space; everything else belongs to a word.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[ \t\n\x0B\f\r]+"


CHUNK = 4 << 20


def chunks(data: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut behind a space; a longer word stays whole."""
    at = 0
    while len(data) - at > size:
        end = data.find(b" ", at + size) + 1
        if not end:
            break
        yield data[at:end]
        at = end
    yield data[at:]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def stored(df: DataFrame, name: str, codec: str = "snappy", keep: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows never recomputes it.

    Its shuffle files go once it is written.  ``keep`` lets it outlive a ``scratch``.
    """
    spark = df.sparkSession
    path = fresh(spark, f"llm-{name}")
    made = _SCRATCH.get()
    if made is not None and not keep:
        made.append(path)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables ``stored`` inside are deleted at the end, unless marked ``keep``: what leaves must not read them."""
    made: list[str] = []
    token = _SCRATCH.set(made)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        _remove(spark, made)


def dropped(table: DataFrame) -> None:
    """Deletes a ``stored`` table that nothing reads any more."""
    _remove(table.sparkSession, list({file.rpartition("/")[0] for file in table.inputFiles()}))


def whole(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold_of(column: str, folds: int) -> Column:
    """CRC-32 of an id's decimal text, modulo ``folds``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def salt_of(parts: int, *columns: str) -> Column:
    """A spread number in ``0 .. parts - 1`` that a retried task computes again alike."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(parts))


def salted(df: DataFrame, parts: int, name: str = "__salt") -> DataFrame:
    """Every row once per salt, to meet rows that were dealt out by ``salt_of``."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], count: str, spread_by: list[str], how: str = "left", share: int = 400, salts: int = 64) -> DataFrame:
    """Equi-join on keys that few rows of ``right`` (one per key) may share with very many of ``left``.

    ``right`` carries how many left rows a key has.  Keys with more than one
    ``share``-th of them are at most ``share`` in number, so the driver may hold them;
    their left rows are dealt over ``salts`` parts and their right rows repeated as often.
    ``right`` should be stored: it is read twice.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    hot = [r[0] for r in right.filter(F.col(count) * share > total).select(keys[0]).collect()]
    is_hot = F.col(keys[0]).isin(hot) if hot else F.lit(False)
    dealt = left.withColumn("__salt", F.when(is_hot, salt_of(salts, *spread_by)).otherwise(F.lit(0).cast("long")))
    parts = F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    met = right.withColumn("__salt", F.explode(parts))
    return dealt.join(met, [*keys, "__salt"], how).drop("__salt")
