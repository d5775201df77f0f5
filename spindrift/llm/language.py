"""Language by compression: the dictionary that packs a text smallest names its language.

Each language has a zstandard raw-content dictionary, cut from a bounded sample of
labelled texts. A text is reduced to lower-case letters and spaces, cut into pieces
of a few KiB, so that a long text can't become its own dictionary, and each piece is
compressed with every dictionary. Sizes are summed over the whole text.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_order, ids_and_texts

DICTIONARY_BYTES = 131_072
SAMPLE_ROWS = 400  # different labelled texts a language, about; the bound of the fit
SAMPLE_CHARS = 2_000  # of a passage from each of those
PIECE_BYTES = 4_096
SHORT_BYTES = 200  # a piece below this is compressed behind a passage of the dictionary
FILLER_BYTES = 512
LEVEL = 3
MIN_MARGIN = 0.005
UNKNOWN = "und"

_NO_LETTERS = re.compile(r"[\W\d_]+")
_FORMAT = zstandard.FORMAT_ZSTD1_MAGICLESS


def _plain(text: str) -> str:
    """Lower-case letters; anything else becomes one space."""
    return _NO_LETTERS.sub(" ", text.lower()).strip()


def fit_dictionaries(
    df: DataFrame, where: Column | None = None, text_col: str = "text", lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
) -> dict[str, bytes]:
    """Dictionary bytes by language, the language with most rows first.

    Reads ``text_col`` and ``lang_col`` of the rows that ``where`` admits. About ``sample_rows``
    different texts of each language are taken, by the smallest hashes of the text (a language with
    fewer gives all), and of each a passage of at most ``SAMPLE_CHARS`` characters from anywhere in it; copies
    count once, whatever their ids. Counts cover all rows.
    """
    rows = df if where is None else df.filter(where)
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("_whole")).filter("lang IS NOT NULL AND _whole <> ''")
    at = rows.select("lang", hash_order(F.col("_whole"), 8).alias("_at"), "_whole")
    counts = sorted(
        ((r["n"], r["texts"], r["lang"]) for r in at.groupBy("lang", "_at").agg(F.count(F.lit(1)).alias("_n"))
         .groupBy("lang").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("texts")).collect()),
        key=lambda r: (-r[0], r[2]),
    )
    if not counts:
        return {}
    shares = F.create_map(*[F.lit(x) for _, texts, lang in counts for x in (lang, min(1.0, sample_rows / texts))])
    start = F.floor(hash_order(F.col("_whole"), 9) * (F.greatest(F.length("_whole") - SAMPLE_CHARS, F.lit(0)) + 1)).cast("int") + 1
    found = (
        at.filter(F.col("_at") < shares[F.col("lang")])
        .select("lang", "_at", F.col("_whole").substr(start, F.lit(SAMPLE_CHARS)).alias("text"))
        .groupBy("lang", "_at").agg(F.min("text").alias("text")).collect()
    )
    out = {}
    for _, _, lang in counts:
        texts = [_plain(r["text"]) for r in sorted((r for r in found if r["lang"] == lang), key=lambda r: (r["_at"], r["text"]))]
        # copies teach nothing new
        joined = " ".join(dict.fromkeys(t for t in texts if t)).encode("utf-8", "replace")
        # matches are cheapest near the end, where the first texts go
        if len(joined) >= 8:
            out[lang] = joined[:DICTIONARY_BYTES]
    return out


def _compressors(dictionaries: dict[str, bytes]):
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=_FORMAT, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    found = []
    for data in dictionaries.values():
        d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        filler = data[len(data) // 2 :][:FILLER_BYTES]
        c = zstandard.ZstdCompressor(dict_data=d, compression_params=params)
        found.append((c, filler, len(c.compress(filler))))
    return found


def _sizes(text: bytes, compressors) -> list[int]:
    pieces = [text[i : i + PIECE_BYTES] for i in range(0, len(text), PIECE_BYTES)]
    return [
        sum(
            len(c.compress(p)) if len(p) >= SHORT_BYTES else len(c.compress(filler + p)) - base
            for p in pieces
        )
        for c, filler, base in compressors
    ]


def predict_language(df: DataFrame, dictionaries: dict[str, bytes], text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` columns of each row with lang_pred, score and rejected.

    ``score`` is the margin: how much smaller the best size is than the second, as a share of the
    second (1 with a single language). ``rejected`` is true below ``MIN_MARGIN`` and for `und`.
    A null text, one without letters, and any text where no dictionary could be fitted are
    `und` with score 0. Equal sizes go to the language with more training rows, and are
    rejected. Equal texts get equal answers; whole texts are read; row order is kept open.
    """
    rows = df.select(F.col(text_col).alias("_text"), *keep)
    names = list(dictionaries)
    extra = "lang_pred string, score double, rejected boolean"
    kept = [f for f in rows.schema.fields if f.name != "_text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), extra])

    def judge(batches):
        compressors = _compressors(dictionaries)
        for batch in batches:
            langs, scores, no = [], [], []
            for text in batch.column(0):
                plain = _plain(text.as_py() or "")
                if not names or not any(map(str.isalpha, set(plain))):
                    langs.append(UNKNOWN), scores.append(0.0), no.append(True)
                    continue
                sizes = _sizes(plain.encode("utf-8", "replace"), compressors)
                best = min(range(len(sizes)), key=sizes.__getitem__)
                rest = min((s for i, s in enumerate(sizes) if i != best), default=None)
                margin = 1.0 if rest is None else (rest - sizes[best]) / max(rest, 1)
                margin = min(1.0, max(0.0, margin))
                langs.append(names[best]), scores.append(margin), no.append(margin < MIN_MARGIN)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(no, pa.bool_())],
                names=[*(f.name for f in kept), "lang_pred", "score", "rejected"],
            )

    return rows.mapInArrow(judge, schema)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True where crc32 of the id as text leaves no remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of each row; learned from rows that are not held out."""
    learn = F.col(id_col).isNotNull() & ~held_out(id_col)
    found = fit_dictionaries(df, learn, text_col, lang_col)
    keep = [F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out")]
    return predict_language(df, found, text_col, keep)


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``df``, all columns, whose language is told with a sufficient margin.

    Learned from all labelled rows. An empty table stays empty.
    """
    found = fit_dictionaries(df, None, text_col, lang_col)
    judged = predict_language(
        df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), df[text_col].alias("_t")), found, "_t", [F.col("_row")]
    )
    return judged.filter("NOT rejected").select("_row.*")
