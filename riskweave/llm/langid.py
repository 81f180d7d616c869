"""Language identification by compression.

Each language has a zstandard raw-content dictionary: text of that language,
taken from a bounded sample of rows whose language is known.  A text is encoded
with every dictionary, in pieces of ``piece`` bytes so that the dictionary and
not the text's own earlier part explains it, and the language whose encoding of
the whole text is smallest is predicted; letter case is folded first.  When the two smallest sizes are
closer than ``margin`` (as a share of the second), the prediction is rejected:
``accepted`` is false, while ``lang_pred`` still names the smallest.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import hash_order, held_out, thinned

SAMPLE_ROWS = 400          # training rows per language at most
DICTIONARY_BYTES = 1 << 17  # dictionary size per language at most
SLACK = 4                  # characters brought per byte of a text's share
PIECE_BYTES = 2048
MARGIN = 0.01
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
SHORT_BYTES = 256
# Short minimum matches: words share short letter runs.
_PARAMETERS = dict(window_log=18, chain_log=16, hash_log=16, search_log=3, min_match=3, target_length=32,
                   strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_dict_id=0, write_checksum=0)


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          modulus: int = 4, remainder: int = 2, rows: int = SAMPLE_ROWS,
          size: int = DICTIONARY_BYTES, seed: int = 8) -> dict[str, bytes]:
    """Dictionary content per language, from rows whose id is not held out.

    ``rows`` and ``size`` bound what is brought to the driver: that many texts per
    language, of each a piece of up to ``SLACK`` times its share of ``size`` bytes,
    in characters, from a hash-chosen place of the whole text.  A language with
    fewer texts takes longer pieces, and what short texts leave of the dictionary
    goes to the longer ones.  Ids are ranked without their texts.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.where(~held_out("id", modulus, remainder)).where("lang is not null and text is not null")
    counts = known.groupBy("lang").count().collect()  # one row per language
    few, width = F.lit(False), F.lit(0)
    for r in counts:
        few = few | ((F.col("lang") == r["lang"]) & thinned("id", seed, rows, r["count"]))
        width = F.when(F.col("lang") == r["lang"], F.lit(SLACK * size // min(rows, r["count"]))).otherwise(width)
    ranked = (known.select("id", "lang").where(few).distinct()
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(hash_order("id", seed), "id")))
              .where(F.col("rank") <= rows))
    places = F.greatest(F.length("text") - F.col("width") + 1, F.lit(1))
    start = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("id")), places).cast("int") + 1
    picked = (known.join(F.broadcast(ranked), ["id", "lang"]).withColumn("width", width)
              .select("lang", "rank", "id", F.col("text").substr(start, F.col("width")).alias("text")).distinct())
    found: dict[str, list[tuple[int, str]]] = {}
    for r in picked.collect():
        found.setdefault(r["lang"], []).append((r["rank"], r["text"]))
    out = {}
    for lang, texts in sorted(found.items()):
        unique = list(dict.fromkeys(t.lower() for _, t in sorted(texts) if _LETTER.search(t)))
        if unique:
            out[lang] = b" ".join(shared([t.encode() for t in unique], size))
    return out


def shared(texts: list[bytes], size: int) -> list[bytes]:
    """Starts of ``texts`` of ``size`` bytes together, one blank between two counted:
    all the same length but for texts that are shorter."""
    out, left = list(texts), size - len(texts) + 1
    for done, i in enumerate(sorted(range(len(texts)), key=lambda n: len(texts[n]))):
        out[i] = texts[i][:max(0, left // (len(texts) - done))]
        left -= len(out[i])
    return out


def _compressors(dictionaries: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    parameters = zstandard.ZstdCompressionParameters(**_PARAMETERS)
    out = []
    for lang, content in dictionaries.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=parameters)
        out.append((lang, zstandard.ZstdCompressor(dict_data=d, compression_params=parameters)))
    return out


def classify(text: str | None, coders: list, piece: int = PIECE_BYTES) -> tuple[str, float, float]:
    """(language, score, margin) of one text."""
    if not text or not coders or not _LETTER.search(text):
        return UNDETERMINED, 0.0, 0.0
    raw = text.lower().encode()
    if len(raw) < SHORT_BYTES:  # too short to be worth a compressed block: repeated
        raw = (raw + b" ") * -(-SHORT_BYTES // (len(raw) + 1))
    sizes = [sum(len(c.compress(raw[i:i + piece])) for i in range(0, len(raw), piece)) for _, c in coders]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    rest = sorted(sizes[:best] + sizes[best + 1:])
    margin = 1.0 - sizes[best] / rest[0] if rest else 1.0
    weight = [math.exp(-min(60.0, 40.0 * (s / sizes[best] - 1.0))) for s in sizes]
    return coders[best][0], weight[best] / sum(weight), margin


def predict(docs: DataFrame, dictionaries: dict[str, bytes], *, id_col: str = "doc_id", text_col: str = "text",
            modulus: int = 4, remainder: int = 2, piece: int = PIECE_BYTES, margin: float = MARGIN) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, accepted.

    Null, empty and letterless texts are ``und`` with score 0 and not accepted,
    and so is every text when no language was learned.  Equal sizes go to the
    language that sorts first.  Repeated rows are returned as often as they
    come; other columns are ignored.
    """
    schema = "struct<lang_pred:string,score:double,margin:double>"

    @F.arrow_udf(schema)
    def detect(texts: pa.Array) -> pa.Array:
        coders = _compressors(dictionaries)
        rows = [classify(t, coders, piece) for t in texts.to_pylist()]
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.StructArray.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()),
                                           pa.array(cols[2], pa.float64())], ["lang_pred", "score", "margin"])

    out = docs.select(F.col(id_col).alias("doc_id"), detect(F.col(text_col)).alias("p"))
    return out.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "p.lang_pred", "p.score",
                      ((F.col("p.margin") >= margin) & (F.col("p.lang_pred") != UNDETERMINED)).alias("accepted"))


def language_id(docs: DataFrame, **options) -> DataFrame:
    """Train on the rows that are not held out and predict every row."""
    return predict(docs, train(docs, **options), **{k: v for k, v in options.items()
                                                   if k in ("id_col", "text_col", "modulus", "remainder")})
