"""What the corpus operators have in common: words, carried columns, written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_own_dirs: dict[str, str] = {}


def words(text: Column) -> Column:
    """The words of a text as an array; empty for null and for texts without a word."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def carried(df: DataFrame, derived: list[str]) -> list[str]:
    """Columns of `df` that are kept beside the derived ones, which win where names clash.

    Names are compared as Spark resolves them, without case.
    """
    taken = {name.lower() for name in derived}
    return [name for name in df.columns if name.lower() not in taken]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Only where `spark.checkpoint.dir` is unset and all tasks run on this machine, as in tests,
    a local folder is made instead; on a cluster that is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if named:
        return f"{named.rstrip('/')}/corpus-{app}"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="corpus-")
    return f"file://{_own_dirs[app]}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """`df` as a table in the shared folder: computed once, and safe from lost executors.

    `codec` compresses it otherwise than the session would.

    Its size is known to the planner from then on, so Catalyst broadcasts it in a join
    only if it is below the session's threshold.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
