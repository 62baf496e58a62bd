"""Language identification by compression (operator 10).

Each language gets one zstandard raw-content dictionary: texts of a bounded
sample of labelled rows, joined up to ``dictionary_bytes``.  Texts are reduced
to lower-case letters and single spaces.  A text is compressed whole, in
pieces of ``piece_bytes`` so that the dictionary matters to its end as much as
to its start, with every dictionary; the language that needs the fewest bytes
wins.  A margin below ``min_margin`` of the next size marks the prediction as
rejected.

Defined results: null text, or text without a letter: ``und``, score 0,
rejected.  No labelled row at all: ``und`` for every row.  Ties go to the
language whose name sorts first.  Texts are never cut.  Extra columns of the
input do not matter; only the key and the text are read.
"""
from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import stage

UNDETERMINED = "und"
_REST = re.compile(r"[\W\d_]+")


def train(docs: DataFrame, learn, key: str = "doc_id", text: str = "text", lang: str = "lang",
          texts_per_language: int = 200, short_bytes: int = 2048, dictionary_bytes: int = 48 << 10,
          model_bytes: int = 32 << 20) -> dict[str, bytes]:
    """Dictionaries by language from the rows where ``learn`` holds.

    Every language gets one, from ``texts_per_language`` rows: texts of at most
    ``short_bytes`` first, then by hash of the key.  All together have at most
    ``model_bytes``, which is what reaches the driver and the tasks: with very
    many languages each dictionary is smaller than ``dictionary_bytes``.
    """
    rows = docs.where(learn).where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0))
    n_languages = rows.select(lang).distinct().count()
    if not n_languages:
        return {}
    most = max(1, min(dictionary_bytes, model_bytes // n_languages))
    order = Window.partitionBy("_l").orderBy("_s", "_h", "_k")
    ids = (rows.select(F.col(key).alias("_k"), F.col(lang).alias("_l"), F.xxhash64(key).alias("_h"),
                       (F.octet_length(text) > short_bytes).alias("_s"))
           .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= texts_per_language))
    ids = stage(ids.select("_k", "_n"), "langid-sample")
    picked = (rows.join(ids, F.col(key) == F.col("_k"))
              .select(F.col(lang).alias("l"), "_n", F.col(text).cast("binary").alias("t")))

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by([("_n", "ascending")])
        parts = [reduced(x.decode())[:most] for x in t.column("t").to_pylist()]
        # what stands last in a dictionary is nearest and cheapest to refer to
        return pa.table({"l": t.column("l").slice(0, 1), "d": pa.array([b"\n".join(parts)[:most]], pa.binary())})

    got = picked.groupBy("l").applyInArrow(build, "l string, d binary").collect()
    return {r.l: bytes(r.d) for r in sorted(got, key=lambda r: r.l)}


def reduced(text: str) -> bytes:
    return _REST.sub(" ", text.lower()).encode()


class Classifier:
    def __init__(self, model: dict[str, bytes], level: int, piece_bytes: int):
        self.piece = piece_bytes
        self.names = sorted(model)
        self.coders = []
        for n in self.names:
            d = zstd.ZstdCompressionDict(model[n], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstd.ZstdCompressor(dict_data=d, level=level, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False))

    def __call__(self, text: str) -> tuple[str, float, float]:
        """(language, score, margin as a share of the next size)."""
        data = reduced(text)
        pieces = [data[i:i + self.piece] for i in range(0, len(data), self.piece)]
        sizes = [sum([len(c.compress(p)) for p in pieces]) for c in self.coders]
        best = min(range(len(sizes)), key=lambda i: sizes[i])
        if len(sizes) == 1:
            return self.names[0], 1.0, 1.0
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = (second - sizes[best]) / max(1, second)
        return self.names[best], second / (second + sizes[best]) if margin else 0.5, margin


_built: dict = {}


def predict(docs: DataFrame, model: dict[str, bytes], key: str = "doc_id", text: str = "text",
            min_margin: float = 0.01, level: int = 5, piece_bytes: int = 2048) -> DataFrame:
    """(key, lang_pred, score, margin, rejected) of every row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by train()
    name = hashlib.sha256(repr((level, piece_bytes, sorted(model.items()))).encode()).hexdigest()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        if _built.get("name") != name:
            _built.update(name=name, of=Classifier(shared.value, level, piece_bytes) if shared.value else None)
        classify = _built["of"]
        for b in batches:
            names, scores, margins = [], [], []
            for t in b.column(text).cast(pa.string()):
                t = t.as_py()
                if classify is None or t is None or not any(map(str.isalpha, t)):
                    n, s, m = UNDETERMINED, 0.0, 0.0
                else:
                    n, s, m = classify(t)
                names.append(n)
                scores.append(s)
                margins.append(m)
            yield pa.RecordBatch.from_arrays(
                [b.column(key), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(margins, pa.float64()), pa.array([m < min_margin for m in margins], pa.bool_())],
                [key, "lang_pred", "score", "margin", "rejected"])

    return docs.select(key, text).mapInArrow(
        run, f"{key} {kind}, lang_pred string, score double, margin double, rejected boolean")
