"""Statistics of whole texts, appended to their rows by an Arrow task (one pass, no shuffle)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from tierkit.llm.common import fresh

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower",
         "n_digits", "n_distinct", "n_echo", "n_marked", "n_longest", "n_stops", "n_bare"]
_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_ALNUM = _UPPER + _LOWER + _DIGITS


def window_repeats(ids: np.ndarray, kinds: int, width: int = 5) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    key, span = ids[:n].copy(), kinds
    for j in range(1, width):
        if span * kinds >= 1 << 62:  # too large for one number: places of the sorted keys do as well
            key = np.unique(key, return_inverse=True)[1]
            span = int(key.max()) + 1
        key, span = key * kinds + ids[j : j + n], span * kinds
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def stats_of(text: str) -> tuple[int, ...]:
    """The values of ``STATS``. Words are runs of other characters than the six ASCII white spaces."""
    data = text.encode()
    words = data.split()
    n = len(words)
    places: dict[bytes, int] = {}
    ids = np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, n)
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    count = lambda chars: len(data) - len(data.translate(None, chars))
    latin = data.count(b"\xc3")
    if latin:  # letters of Latin-1 have two bytes: the second tells their case
        raw = np.frombuffer(data, np.uint8)
        second = raw[1:][raw[:-1] == 0xC3]
        up, low = int((second < 0x9F).sum()), int((second >= 0x9F).sum())
    else:
        up = low = 0
    marked = sum(1 for w in places if w[-1] in b"#*$%&|<>!" and len(w) > 1) if n else 0
    bare = [i for w, i in places.items() if w.isascii() and len(w.translate(None, _ALNUM)) == len(w)]
    return (n, len(text) - count(_SPACE), count(_SYMBOLS), len(lines) - len(set(lines)), window_repeats(ids, len(places)),
            len(lines), count(_UPPER) + up, count(_LOWER) + low, count(_DIGITS), len(places),
            int((ids[1:] == ids[:-1]).sum()), marked, max(map(len, places), default=0),
            sum(1 for w in words if w[-1] in b".,;:?"), int(np.isin(ids, bare).sum()) if bare else 0)


def with_stats(df: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``df`` with one more column, a struct of ``STATS``; and its name. A null text counts as empty."""
    name = fresh(df, "text_stats")
    schema = StructType([*df.schema.fields, StructField(name, StructType([StructField(s, LongType()) for s in STATS]))])
    at = df.columns.index(text)

    def run(batches):
        for b in batches:
            rows = np.zeros((b.num_rows, len(STATS)), np.int64)
            for i in range(0, b.num_rows, 512):  # a few texts as Python objects at a time
                part = b.column(at).slice(i, 512).to_pylist()
                rows[i : i + len(part)] = [stats_of(t or "") for t in part]
            stats = pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], names=STATS)
            yield pa.RecordBatch.from_arrays([*b.columns, stats], names=schema.names)

    return df.mapInArrow(run, schema), name
