"""Language identification by compression.

Every language has a Zstandard dictionary of raw text. A text is encoded once with each, in pieces
of a fixed size, and the language whose dictionary makes the sum of the pieces smallest is chosen.
Where the runner-up comes too close, the decision is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import slices

LEVEL = 6
# The sample the dictionaries are made of: so many labelled texts a language, chosen by hash of
# their id, and so many characters of each. The model's size is bounded by these two and by the
# number of languages, whatever the size of the input.
SAMPLE_TEXTS = 320
SAMPLE_CHARS = 3000
DICTIONARY_BYTES = 400 << 10
# Every piece is a frame of its own. In one long frame the dictionary leaves the window, and only
# the beginning of the text would tell languages apart.
PIECE_BYTES = 64 << 10
MARGIN = 0.002  # share of the encoded size by which the runner-up must be larger
SHARPNESS = 0.25  # how fast the score rises with the difference in bytes
UNKNOWN = "und"

NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """The words of a text in lower case; digits, signs and layout say little about a language."""
    return NO_LETTERS.sub(" ", text.lower()).strip()


def learn(
    labelled: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    by: str = "doc_id",
    texts: int = SAMPLE_TEXTS,
    chars: int = SAMPLE_CHARS,
) -> dict[str, bytes]:
    """A dictionary for every language of ``labelled``, from a bounded sample of its rows.

    Languages come in descending order of their number of labelled rows, which decides ties.
    Rows without text, letters or language teach nothing; copies of a text count once in the
    sample. Without any labelled row the model is empty.
    """
    counts = labelled.groupBy(F.col(lang).alias("lang")).count().where("lang IS NOT NULL")
    rows = labelled.select(
        F.col(lang).alias("lang"),
        F.substring(F.col(text), 1, chars).alias("text"),
        F.xxhash64(F.col(by)).alias("order"),
    ).where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    order = Window.partitionBy("lang").orderBy("order", "text")
    sample = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= texts)
    chosen: dict[str, dict[str, None]] = {}
    sample = sample.join(counts, "lang").orderBy(F.desc("count"), "lang", "place")
    for row in sample.collect():  # at most ``texts`` a language
        chosen.setdefault(row["lang"], {})[letters(row["text"])] = None
    return {
        name: "\n".join(found).encode()[:DICTIONARY_BYTES] for name, found in chosen.items()
    }


Coders = list[tuple[str, zstandard.ZstdCompressor]]


def coders(model: dict[str, bytes], level: int = LEVEL) -> Coders:
    """An encoder for each language of ``model``, in its order."""
    made = []
    for name, content in model.items():
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=level)
        coder = zstandard.ZstdCompressor(
            level=level,
            dict_data=held,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        made.append((name, coder))
    return made


def encoded_sizes(data: bytes, languages: Coders) -> np.ndarray:
    """The bytes that all pieces of ``data`` take together, for each language."""
    sizes = np.zeros(len(languages))
    for at in range(0, len(data), PIECE_BYTES):
        piece = data[at : at + PIECE_BYTES]
        sizes += [len(coder.compress(piece)) for _, coder in languages]
    return sizes


def decide(
    text: str | None, languages: Coders, margin: float = MARGIN
) -> tuple[str, float, float, bool]:
    """(language, score, margin, rejected). Score is the weight of the choice among all languages,
    each weighing less by its extra bytes. A null text, or one without a letter, is unknown, with
    score 0, and so is every text if nothing was learned. Ties go to the first of the model."""
    words = letters(text or "")
    if not any(map(str.isalpha, words)) or not languages:  # fractions and the like may be left
        return UNKNOWN, 0.0, 0.0, True
    data = words.encode()
    sizes = encoded_sizes(data, languages)
    best = int(sizes.argmin())
    score = 1.0 / float(np.exp(-SHARPNESS * np.minimum(sizes - sizes[best], 700.0)).sum())
    others = np.delete(sizes, best)
    lead = float((others.min() - sizes[best]) / others.min()) if len(others) else 1.0
    return languages[best][0], score, lead, lead < margin


RESULT = "lang_pred string, score double, margin double, rejected boolean"
KINDS = [
    pa.field("lang_pred", pa.string()),
    pa.field("score", pa.float64()),
    pa.field("margin", pa.float64()),
    pa.field("rejected", pa.bool_()),
]


def identify(
    docs: DataFrame,
    model: dict[str, bytes],
    *,
    text: str = "text",
    margin: float = MARGIN,
) -> DataFrame:
    """``docs`` with one struct column __lang of lang_pred, score, margin and rejected.

    Only the text decides. Every row keeps its columns, and repeated rows stay repeated.

    The function is marked as if it were not deterministic: a filter on its result then stays behind
    it, where the optimizer would otherwise run it once for the filter and again for the column.
    """

    @F.arrow_udf(RESULT)
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        languages = coders(model)
        for texts in batches:
            found = [
                decide(text, languages, margin)
                for part in slices([texts])
                for text in part.to_pylist()
            ]
            columns = zip(*found, strict=True) if found else [[]] * len(KINDS)
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, KINDS, strict=True)], fields=KINDS
            )

    return docs.withColumn("__lang", guess.asNondeterministic()(F.col(f"`{text}`")))
