"""Awkward documents that every text operator must handle."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, length int, number int, words string"
PROSE = "The old mill by the river turns slowly and the miller counts the sacks of flour that the carts bring in. "
TEXTS = [
    None,
    "",
    " ",
    "\n\n\t \r\n",
    "word",
    "two  words\x0band\x0cmore \x85 \xa0   x\x1c \x1cy",
    "It's they're I'LL we'd don't 'tis <|endoftext|> <|startoftext|>",
    "Ünïcödé 漢字かな交じり文 🙂🙃 é नमस्ते 12345 $%&# ​",
    "a" * 3000,
    " " * 500 + "x" + "\n" * 500,
    PROSE * 40,
    PROSE * 40,
    "Line one is here\nLine one is here\nLine two\n\n" + PROSE,
    " ".join(f"w{i * 7919 % 4001}" for i in range(30_000)),
]


def documents(spark: SparkSession, texts=TEXTS) -> DataFrame:
    """The texts under ascending ids, a repeated row, and rows without an id."""
    rows = [(i * 3, t, "en", "s", None, "clash", 1, 2, "clash") for i, t in enumerate(texts)]
    if texts:
        rows += [rows[-1], (None, PROSE, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def rows_of(docs: DataFrame) -> list[tuple]:
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
