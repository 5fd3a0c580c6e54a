"""Operator 4: language identification by compression.

Each language has a zstandard raw-content dictionary cut from labelled texts. A text is encoded
with every dictionary, and the language whose dictionary gives the fewest bytes wins. So that a
long text's own history does not drown the dictionaries, the whole text is encoded in windows and
the bytes are summed. Where the two best are too close for the text's length, the row is marked
as rejected.

The dictionaries are fitted on a bounded sample: PIECES pieces of at most PIECE characters a
language, from distinct texts in the order of a hash of the text, so copies count once. Every
row is classified, from its text alone. Letters are lower-cased and other characters become single
spaces first, so capitals, digits and marks do not hide a language.

Nulls: a null text, or one without a letter, is `und` with score 0 and rejected; rows with a null
lang are classified and never learned from; a null doc_id counts as held out. With no labelled
row at all, every row is `und`. Empty tables give an empty result; ties go to the language that
sorts first. Repeated rows are rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ensure, lean, materialize, near, slices_of

PIECES, PIECE = 64, 1000
#: Characters encoded at once.
WINDOW = 3000
#: Rejected when the runner-up needs less than MARGIN more bytes, as a share of the best.
MARGIN = 0.005
FOLDS = 5
_OTHER = re.compile(r"[\W\d_]+")


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def fit(docs: DataFrame, pieces: int = PIECES, piece: int = PIECE) -> dict[str, bytes]:
    """Raw-content dictionary of each language among the labelled rows that are not held out."""
    rows = ensure(docs, doc_id="long", text="string", lang="string")
    rows = rows.where(F.col("lang").isNotNull() & ~held_out() & (F.length(F.trim("text")) > 0))
    # Only hashes are ranked; copies of one text share a hash and count once. The lowest hashes win, so all but about
    # the lowest 4 * pieces of a language go by a threshold before any are gathered.
    hashed = rows.select("lang", F.xxhash64("text").alias("h"), "text")
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    share = F.least(F.lit(1.0), 4.0 * pieces / F.col("n"))
    bar = sizes.select("lang", F.when(F.col("n") <= 4 * pieces, F.lit((1 << 63) - 1)).otherwise((share * 2.0**64 - 2.0**63).cast("long")).alias("bar"))
    low = hashed.join(near(materialize(bar, "lang-bars")), "lang").where("h <= bar").select("lang", "h").distinct()
    first = low.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("k") <= pieces)
    first = materialize(first.select("lang", "h"), "lang-sample")
    # A window of the text at a place its hash decides.
    start = (F.pmod("h", F.greatest(F.length("text") - piece + 1, F.lit(1))) + 1).cast("int")
    cut = hashed.join(near(first), ["lang", "h"]).groupBy("lang", "h").agg(F.min(F.substring(F.col("text"), start, F.lit(piece))).alias("cut")).collect()  # pieces a language at most
    out: dict[str, list] = {}
    for r in sorted(cut, key=lambda r: (r.lang, r.h)):
        out.setdefault(r.lang, []).append(folded(r.cut))
    return {lang: "\n".join(cuts).encode("utf-8", "replace") for lang, cuts in out.items()}


def folded(text: str) -> str:
    return _OTHER.sub(" ", text.lower())


def encoder(dictionaries: dict[str, bytes], window: int):
    """Function from a folded text to the bytes it needs with each dictionary, languages in order."""
    import zstandard as zstd

    # Short matches tell languages apart: strings of four bytes count.
    params = zstd.ZstdCompressionParameters(window_log=17, chain_log=15, hash_log=15, search_log=2, min_match=4, strategy=zstd.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
    coders = []
    for lang in sorted(dictionaries):
        known = zstd.ZstdCompressionDict(dictionaries[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=params)
        coders.append(zstd.ZstdCompressor(compression_params=params, dict_data=known))

    def sizes(text: str) -> list[int]:
        parts = [text[i : i + window].encode("utf-8", "replace") for i in range(0, len(text), window)] or [b""]
        return [sum(len(coder.compress(part)) for part in parts) for coder in coders]

    return sizes


def classify(docs: DataFrame, dictionaries: dict[str, bytes], window: int = WINDOW, margin: float = MARGIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, margin for every row of docs."""
    rows = ensure(docs, doc_id="long", text="string").select("doc_id", held_out().alias("held_out"), "text")
    langs = sorted(dictionaries)

    def run(batches):
        import math

        import pyarrow as pa
        import regex

        letter = regex.compile(r"\p{L}")
        sizes = encoder(dictionaries, window)
        for batch in slices_of(batches):
            pred, score, gaps = [], [], []
            for text in batch.column("text").to_pylist():
                if not langs or not text or not letter.search(text):
                    pred.append("und"), score.append(0.0), gaps.append(0.0)
                    continue
                need = sizes(folded(text))
                best = min(range(len(langs)), key=lambda k: (need[k], k))
                # The share of the best among weights that fall off with the bytes saved.
                mass = sum(math.exp(-40 * (x - need[best]) / need[best]) for x in need)
                rest = [x for k, x in enumerate(need) if k != best]
                pred.append(langs[best]), score.append(1 / mass), gaps.append((min(rest) - need[best]) / need[best] if rest else 1.0)
            rejected = [p == "und" or g < margin for p, g in zip(pred, gaps, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_()), pa.array(gaps, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected", "margin"],
            )

    return rows.mapInArrow(lean(run), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean, margin double")
