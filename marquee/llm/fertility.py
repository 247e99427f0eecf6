"""Quality rules: basic counts and tokeniser fertility with bands per language.

A public sentence-piece vocabulary with byte fallback is run over every word
of a text. Three measures tell how natural a text is to it:

* characters per token (fertility): symbol runs, capitals and tables are cut
  into more tokens than running text of the same language;
* byte-fallback share: the part of the tokens that are raw bytes;
* token entropy: bits per token of the text's own token histogram, over the
  bits that the number of tokens allows: loops of a few words are low.

The bands are not set by hand. For every language (or, where a row names none,
every script) and length class (powers of two of the token count, as entropy
depends on length) the measures' median and spread over different texts give the
limits; a document outside the wider of its groups' bands is rejected. A
measure's spread is its median absolute deviation, so the junk in a group does
not widen the band.

Copies and near copies of one text must not make the band theirs. Texts of a
group with the same sketch, the least hash of their windows of five tokens, count
once; near copies share it unless their differences fall on that window. And a
group that is narrow even so goes by its wider group: by the language as a whole,
or the length class in all languages.

Edge cases: NULL text has no words and fails the base rule, as does an empty
text; where a language has fewer than ``MIN_GROUP`` different texts of a
length class, fertility and byte share go by the language as a whole and
entropy by the length class in all languages, and where those are as small
there is no limit; an empty table gives no rows; repeated rows are judged
alike; NULL languages go by script; extra columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ship_package, stage
from marquee.llm.tokens import _Generations, vocabulary

VOCABULARY = "piece_bpe_32k.model"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 100
#: groups whose limits are broadcast; more are joined by shuffle
MAX_BROADCAST = 10_000
_ROWS_AT_ONCE = 1000
#: tokens of a sketch's windows
_WINDOW = 5
#: allowed distance from the median, in median absolute deviations (below,
#: above), the least distance, so that a uniform group keeps a band, and the
#: groups to go by, narrowest first
BANDS: dict[str, tuple[float | None, float | None, float, tuple[str, ...]]] = {
    "chars_per_token": (7.0, 10.0, 0.15, ("concat(language, '|', octave)", "concat(language, '|')")),
    "byte_share": (None, 10.0, 0.02, ("concat(language, '|', octave)", "concat(language, '|')")),
    "entropy_ratio": (4.5, None, 0.06, ("concat(language, '|', octave)", "concat('|', octave)")),
}

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: scripts by code point ranges (fixed values of Unicode); others count as Latin
_SCRIPTS = {
    "Greek": "Ͱ-Ͽἀ-῿",
    "Cyrillic": "Ѐ-ԯ",
    "Hebrew": "֐-׿",
    "Arabic": "؀-ۿݐ-ݿ",
    "Devanagari": "ऀ-ॿ",
    "Thai": "฀-๿",
    "Kana": "぀-ヿ",
    "Han": "㐀-䶿一-鿿",
    "Hangul": "가-힯",
}
_BEYOND_LATIN = re.compile("[Ͱ-᷿ἀ-῿぀-￿]")

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_tokens long, chars_per_token double, byte_share double, entropy_ratio double, script string"
)


class _Pieces:
    """Token ids of single words, two bytes each."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([model.is_byte(i) for i in range(model.vocab_size())])
        self.words = _Generations(lambda w: array("H", model.encode(w)).tobytes(), 250_000)


_loaded: dict[str, _Pieces] = {}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _sketch(ids: np.ndarray) -> int:
    """The least hash of the windows of ``_WINDOW`` tokens; of all tokens of
    a shorter text."""
    h = np.zeros(max(len(ids) - _WINDOW + 1, 1), np.uint64)
    for i in range(min(_WINDOW, len(ids))):
        h = (h + ids[i : i + len(h)]) * _MIX
        h ^= h >> np.uint64(29)
    return int((h * _MIX).min() >> np.uint64(1))


def _script(text: str) -> str:
    if not _BEYOND_LATIN.search(text):
        return "Latin"
    counts = {name: len(re.findall(f"[{r}]", text)) for name, r in _SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if 2 * counts[best] > len(text) - sum(map(text.count, SPACE)) else "Latin"


def _repeated(words: list[str]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    if len(words) < 4:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    m = np.uint64(0x9E3779B97F4A7C15)
    h3 = (h[:-2] * m + h[1:-1]) * m + h[2:]
    order = np.sort(h3)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(h3, twice)
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : len(words) - 2 + i] |= hit
    return int(covered.sum())


def measure(text: str, pieces: _Pieces) -> tuple:
    """The row of ``MEASURES`` and the sketch of one whole text."""
    word_chars = len(text) - sum(map(text.count, SPACE))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
    repeated = _repeated(words)
    pieces.words.trim()
    ids = np.frombuffer(b"".join(map(pieces.words.__getitem__, words)), "<u2")
    n = len(ids)
    if n:
        counts = np.bincount(ids)
        counts = counts[counts > 0]
        bits = np.log2(n) - float((counts * np.log2(counts)).sum()) / n
        entropy = bits / np.log2(min(n, len(pieces.is_byte))) if n > 1 else 1.0
        fertility, share = word_chars / n, float(pieces.is_byte[ids].mean())
    else:
        fertility = share = entropy = None
    counts = len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated, n
    return *counts, fertility, share, entropy, _script(text), _sketch(ids)


def measures(docs: DataFrame, text: str = "text", keep: list[str] | None = None, vocabulary_path: str | None = None) -> DataFrame:
    """``docs``' columns ``keep`` (default: all), the measures of each text and its sketch."""
    ship_package(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    vocabulary_path = vocabulary_path or vocabulary(VOCABULARY)
    row = f"{MEASURES}, sketch long"
    names = [m.split()[0] for m in row.split(",")]
    kinds = [{"long": pa.int64(), "double": pa.float64(), "string": pa.string()}[m.split()[1]] for m in row.split(",")]

    kept = len(keep)
    at = keep.index(text) if text in keep else kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary_path not in _loaded:
            _loaded[vocabulary_path] = _Pieces(vocabulary_path)
        pieces = _loaded[vocabulary_path]
        for batch in (b.slice(at, _ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, _ROWS_AT_ONCE)):
            rows = [measure(v.as_py() or "", pieces) for v in batch.column(at)]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], *(pa.array(c, t) for c, t in zip(columns, kinds))], names=[*batch.schema.names[:kept], *names]
            )

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([F.col(text)] if at == kept else []))
    schema = ", ".join([*(f"`{n}` {t}" for n, t in rows.dtypes[:kept]), row])
    return rows.mapInArrow(run, schema)


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")


_LEVELS = list(dict.fromkeys(level for *_, levels in BANDS.values() for level in levels))


def bands(measured: DataFrame) -> DataFrame:
    """Limits (level, <measure>_low, <measure>_high) from all different texts
    that pass the base rule, for every group of at least ``MIN_GROUP``."""
    names = list(BANDS)
    one = F.min_by(F.struct(*names), F.xxhash64(*names))
    different = (
        measured.where(~base_failed() & (F.col("n_tokens") > 0))
        .groupBy("language", "octave", "sketch").agg(one.alias("one")).select("language", "octave", "one.*")
    )
    spread = stage(different, "fertility-texts").selectExpr(
        f"explode(array({', '.join(_LEVELS)})) as level", *names
    )
    centre = spread.groupBy("level").agg(
        F.count("*").alias("n"), *[F.percentile_approx(m, 0.5, 1000).alias(f"{m}_mid") for m in names]
    )
    centre = stage(centre, "fertility-centres")
    if centre.count() <= MAX_BROADCAST:
        centre = F.broadcast(centre)
    deviation = (
        spread.join(centre, "level").where(F.col("n") >= MIN_GROUP)
        .groupBy("level")
        .agg(
            *[F.first(f"{m}_mid").alias(f"{m}_mid") for m in names],
            *[F.percentile_approx(F.abs(F.col(m) - F.col(f"{m}_mid")), 0.5, 1000).alias(f"{m}_mad") for m in names],
        )
    )
    limits = []
    for m, (below, above, least, _) in BANDS.items():
        for side, sign, factor in (("low", -1, below), ("high", 1, above)):
            edge = F.lit(sign * float("inf"))
            if factor is not None:
                edge = F.col(f"{m}_mid") + sign * F.greatest(F.col(f"{m}_mad") * factor, F.lit(least))
            limits.append(edge.alias(f"{m}_{side}"))
    return deviation.select("level", F.struct(*limits).alias("band"))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """``docs``' columns ``keep`` with the measures, ``base_failed`` and ``kept``."""
    keep = docs.columns if keep is None else keep
    # names of its own, whatever the columns are called
    mine = [f"k{i}" for i in range(len(keep))]
    text_as = mine[keep.index(text)] if text in keep else "text"
    named = docs.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, mine)],
        F.col(lang).alias("lang"),
        *([] if text in keep else [F.col(text).alias("text")]),
    )
    measured = stage(
        measures(named, text_as, [*mine, "lang"])
        .withColumn("language", F.coalesce("lang", F.concat(F.lit("script "), F.col("script"))))
        .withColumn("octave", F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("string")),
        "fertility",
    )
    limits = stage(bands(measured), "fertility-bands")
    marked = measured
    for i, level in enumerate(_LEVELS):
        marked = marked.withColumn("level", F.expr(level)).join(
            limits.withColumnRenamed("band", f"band{i}"), "level", "left"
        ).drop("level")
    inside = F.lit(True)
    for m, (*_, levels) in BANDS.items():
        bands_ = [F.col(f"band{_LEVELS.index(level)}") for level in levels]
        low, high = F.least(*[b[f"{m}_low"] for b in bands_]), F.greatest(*[b[f"{m}_high"] for b in bands_])
        inside = inside & F.coalesce(F.col(m).between(low, high), F.lit(True))
    return marked.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & inside).select(
        *[F.col(k).alias(c) for k, c in zip(mine, keep)],
        *[m.split()[0] for m in MEASURES.split(",")], "language", "base_failed", "kept",
    )


def accepted(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    judged = judge(renamed, names[docs.columns.index(text)], names[docs.columns.index(lang)], names)
    return judged.where("kept").select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
