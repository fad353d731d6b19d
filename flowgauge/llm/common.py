"""Small helpers that several corpus operators share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its exact name."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) under fixed names, null texts as empty ones."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def mixed(x: Column) -> Column:
    """A bijection of 64-bit integers that scatters neighbouring values (xor and shifts only)."""
    x = x.bitwiseXOR(F.shiftleft(x, 13))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
    return x.bitwiseXOR(F.shiftleft(x, 17))


def slices(sizes, most: int):
    """Consecutive (start, end) ranges whose sizes sum to about ``most``; a single larger item stands alone."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)
