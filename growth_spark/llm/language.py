"""Language identification by compression.

Each learned language has a zstandard dictionary of raw content: whole texts of a bounded sample of its labelled ones.
A text is reduced to lower-case letters with single blanks, cut into frames, and every frame of it is compressed with
every dictionary; the language whose frames are smallest in sum wins. A text is rejected if it has no letter or if the
winner's margin over the next language is narrow, in bytes or as a share of the size.
"""

from __future__ import annotations

from collections.abc import Iterator

import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches

#: Labelled texts that a dictionary is made of at most, its bytes at most (one longer text is a dictionary alone), and bytes
#: of all dictionaries: many languages get smaller ones.
ROWS, DICTIONARY, ALL = 400, 512 << 10, 32 << 20
#: Bytes that are compressed in one frame: short enough that the dictionary, not the text itself, is what helps.
FRAME = 512
LEVEL = 6
#: Below this score the text is measured again in frames of so many bytes, each beginning half way through the last.
DOUBT, FINE = 0.95, 24
#: Margins that are not narrow: bytes between the smallest and the next size, and that as a share of the smallest.
BYTES, SHARE = 2, 0.005
_GAPS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def letters(text: str) -> str:
    """Lower-case letters with their marks, single blanks between runs of them; "" if there is no letter."""
    found = _GAPS.sub(" ", text).strip().lower()
    return found if found.isascii() or _LETTER.search(found) else ""


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = ROWS) -> dict[str, bytes]:
    """Raw dictionary content per language, from at most ``rows`` different labelled texts of each, all of them whole.

    The sample is the first texts in a hash order: each row tells from its own hash and its language's number of texts
    whether it can be one of them, so no more than some 1.25 * ``rows`` of a language are ranked. Of these, in that order,
    as many as ``DICTIONARY`` bytes hold make the dictionary; texts that are longer than it come last, and the first one
    stays whatever its length. Copies count once. Rows with null text or label are
    not learned from; any number of labels will do.
    """
    hashed = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit("sample"), F.col(text)).alias("at")).filter("lang IS NOT NULL AND text IS NOT NULL AND text != ''")
    sizes = {r["lang"]: r["n"] for r in hashed.groupBy("lang").agg(F.approx_count_distinct("at").alias("n")).collect()}
    if not sizes:
        return {}
    size = min(DICTIONARY, ALL // len(sizes))
    # The hash below which a share of all texts lies, that share being a quarter more than the rows that are wanted.
    below = {name: int(1.25 * rows / n * (1 << 64)) - (1 << 63) if 1.25 * rows < n else (1 << 63) - 1 for name, n in sizes.items()}
    limits = F.create_map(*[F.lit(x) for pair in below.items() for x in pair])

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            yield {"lang": batch["lang"], "at": batch["at"], "text": [letters(t).encode() for t in batch["text"].to_pylist()]}

    sampled = map_batches(hashed.filter(F.col("at") <= limits[F.col("lang")]), body, "lang string, at bigint, text binary").filter(F.length("text") > 0)
    order = Window.partitionBy("lang").orderBy(F.length("text") > size, "at")
    filled = F.sum(F.length("text") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = sampled.dropDuplicates(["lang", "at"]).withColumn("k", F.row_number().over(order)).withColumn("filled", filled)
    content: dict[str, list[bytes]] = {}
    for r in ranked.filter((F.col("k") == 1) | (F.col("k") <= rows) & (F.col("filled") <= size)).orderBy("lang", "k").collect():
        content.setdefault(r["lang"], []).append(bytes(r["text"]))
    return {name: b" ".join(parts) for name, parts in content.items()}


class Compressors:
    def __init__(self, content: dict[str, bytes]) -> None:
        import zstandard

        self.names = sorted(content)
        self.each = []
        for name in self.names:
            data = zstandard.ZstdCompressionDict(content[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.each.append(zstandard.ZstdCompressor(dict_data=data, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, score and whether it is rejected."""
        data = letters(text).encode()
        if not data or not self.each:
            return "und", 0.0, True
        sizes = self.sizes(data, FRAME, FRAME)
        if share(sizes) < DOUBT:  # whole bytes are a coarse measure of a short text
            sizes = [a + b for a, b in zip(sizes, self.sizes(data, FINE, FINE // 2), strict=True)]
        return self.names[sizes.index(min(sizes))], share(sizes), narrow(sizes)

    def sizes(self, data: bytes, frame: int, step: int) -> list[int]:
        frames = [data[i : i + frame] for i in range(0, len(data), step)]
        return [sum(len(compress(f)) for f in frames) for compress in self.each]


def share(sizes: list[int]) -> float:
    """The smallest size's part of the likelihood, a byte less being a factor of two."""
    return 1.0 / sum(2.0 ** -min(s - min(sizes), 60) for s in sizes)


def narrow(sizes: list[int]) -> bool:
    """Whether the next size is too near to the smallest; a tie always is. A lone language has no next one."""
    first, *rest = sorted(sizes)
    return bool(rest) and rest[0] - first < max(BYTES, SHARE * first)


def predict(docs: DataFrame, content: dict[str, bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, lang_pred (``und`` if the text is null or has no letter), score and rejected. One pass.

    Of languages that tie the first name stands, and is rejected; an empty text, an empty table and repeated rows are
    ordinary cases. Nothing but the text decides.
    """
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        models = Compressors(shared.value)
        for batch in batches:
            found = [models.predict(t) for t in batch["_text"].to_pylist()]
            yield {key: batch[key], "lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "rejected": [f[2] for f in found]}

    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return map_batches(rows, body, f"{key} {rows.schema[key].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def held_out(key: str = "doc_id") -> F.Column:
    """Rows that nothing is learned from: crc32 of the key as text, mod 5, is 0 (a null key counts as empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def keep_known(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the rows whose language is rejected; learned from its own labelled rows that are not held out.

    The text is judged where it lies, in one pass and without a join; all columns stay as they are.
    """
    content = learn(docs.filter(~held_out(key)), text, lang)
    schema = docs.schema
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        models = Compressors(shared.value)
        for batch in batches:
            found = (models.predict(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist())
            yield batch.filter(pa.array([not rejected for *_, rejected in found], pa.bool_()))

    return docs.mapInArrow(run, schema)
