"""Language identification by compression.

Each language gets a raw-content zstandard dictionary cut from labelled texts.  A text is
encoded with every dictionary; the language whose dictionary gives the fewest bytes wins,
and a narrow margin to the runner-up rejects the text.

Texts are reduced to lower-case letters and single blanks before encoding, so markup, digits
and signs carry no weight.  The whole reduced text is encoded, in blocks of ``BLOCK`` bytes
that each start from the dictionary: in one long frame a text would soon be its own
dictionary and the languages would draw level.

Texts: null, and texts without a letter, are ``und`` with score 0 and are rejected.  Ties go
to the language with more training text, then to the smaller name.  Rows are handled one by
one, so repeated rows and null ids need no rule; with no labelled row every text is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Bound of the training sample, per language: texts, and characters of each text.
SAMPLE_TEXTS, SAMPLE_CHARS = 400, 1_000
#: Bytes of one dictionary.
DICTIONARY_BYTES = 100_000
BLOCK = 2_048
LEVEL = 6
#: Texts of at most this many bytes are encoded at several levels and the sizes averaged:
#: their sizes differ by few whole bytes, and one level alone would often tie.
SHORT, SHORT_LEVELS = 256, (1, 3, 6, 9, 12)
#: A text is rejected if the runner-up needs less than this share of bytes more per letter.
MIN_MARGIN = 0.001

NOT_LETTERS = re.compile(r"[\W\d_]+")


def reduced(text: str | None) -> str:
    """Lower-case letters, runs of anything else as one blank; empty without a letter.

    Numeric signs such as fractions or Roman numerals are no letters, but stay beside them."""
    text = NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""
    return text if any(map(str.isalpha, text)) else ""


def training_sample(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                    texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """At most ``texts`` openings of at most ``chars`` characters per language.

    The rows are those with the smallest text hash, whatever the partitioning; each task
    keeps its own smallest before the shuffle.  Only fitting reads a bounded part.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.substring(F.col(text_col), 1, chars).alias("opening"),
        F.xxhash64(F.col(text_col)).alias("h"))
    # Equal texts have equal hashes: one of them stays, so a copied text fills no sample.
    smallest = rows.groupBy("lang", (F.pmod(F.col("h"), F.lit(texts))).alias("slot")).agg(
        F.min(F.struct("h", "opening")).alias("m"))
    return smallest.select("lang", "m.opening")


def fit(sample: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionary content per language from a bounded sample (``training_sample``)."""
    texts: dict[str, list[str]] = {}
    for lang, opening in sorted((r[0], r[1]) for r in sample.collect()):
        text = reduced(opening)
        if text:
            texts.setdefault(lang, []).append(text)
    out = {}
    for lang, parts in texts.items():
        share = max(40, dictionary_bytes // len(parts))
        out[lang] = " ".join(p[:share] for p in parts).encode("utf-8")[:dictionary_bytes]
    return dict(sorted(out.items(), key=lambda x: (-len(x[1]), x[0])))


class Classifier:
    """Sizes of a text under every language's dictionary, and the decision from them."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL, block: int = BLOCK):
        import zstandard as zstd
        self.block = block
        self.languages = list(dictionaries)

        def coders(at: int) -> list:
            out = []
            for content in dictionaries.values():
                params = zstd.ZstdCompressionParameters.from_level(
                    at, source_size=block, dict_size=len(content), write_content_size=0, write_checksum=0,
                    write_dict_id=0)
                coder = zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(
                    content, dict_type=zstd.DICT_TYPE_RAWCONTENT), compression_params=params)
                out.append((coder, len(coder.compress(b""))))
            return out

        self.coders = [coders(level)]
        self.fine = [coders(x) for x in SHORT_LEVELS]

    def sizes(self, text: str) -> list[float]:
        data = text.encode("utf-8")
        blocks = [data[i:i + self.block] for i in range(0, len(data), self.block)]
        levels = self.fine if len(data) <= SHORT else self.coders
        return [sum(len(level[k][0].compress(b)) - level[k][1] for level in levels for b in blocks) / len(levels)
                for k in range(len(self.languages))]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """``(language, score, margin)``; margin: bytes the runner-up needs more, per letter."""
        text = reduced(text)
        if not text or not self.languages:
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(f" {text} ")
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = sizes[order[0]]
        if len(order) == 1:
            return self.languages[order[0]], 1.0, 1.0
        margin = (sizes[order[1]] - best) / len(text)
        return self.languages[order[0]], 0.5 + 0.5 * min(1.0, margin / 0.25), margin


def predict(text: Column, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> Column:
    """``struct<lang_pred, score, margin, rejected>`` of a text column.

    score: 0 to 1, 0.5 at a tie.  ``rejected`` marks ``und`` and margins under ``min_margin``.
    """
    @F.pandas_udf("lang_pred string, score double, margin double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Classifier(dictionaries)
        for texts in batches:
            rows = [model.predict(t) for t in texts]
            out = pd.DataFrame(rows, columns=["lang_pred", "score", "margin"], index=texts.index)
            out["rejected"] = (out["lang_pred"] == UNKNOWN) | (out["margin"] < min_margin)
            yield out

    # Marked so that a filter on the outcome is not pushed below it with a second evaluation.
    return run.asNondeterministic()(text)
