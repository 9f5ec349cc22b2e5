"""Statistics of whole documents, one slim row to a document, in one pass over the text.

Null texts count as empty; an empty text has all statistics zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import text as tx

COUNTS = (
    "n_bytes", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower",
    "n_digits", "n_bangs", "n_bars", "n_stops", "n_high", "n_same_next", "n_distinct",
)


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)
    table[list(chars)] = 1
    return table


_SPACE = b" \t\n\x0b\x0c\r"
#: Byte classes that are summed over each document.
_CLASSES = {
    "n_symbols": _class(b"#*$%&|<>"),
    "n_upper": _class(bytes(range(65, 91))),
    "n_lower": _class(bytes(range(97, 123))),
    "n_digits": _class(b"0123456789"),
    "n_bangs": _class(b"!?"),
    "n_bars": _class(b"|"),
    "n_stops": _class(b".,;:"),
    "n_high": _class(bytes(range(0xC0, 256))),  # first bytes of characters beyond ASCII
    "_later": _class(bytes(range(0x80, 0xC0))),
    "_space": _class(_SPACE),
}


def _line_repeats(t: bytes) -> tuple[int, int]:
    """Lines with a word, and those among them equal to an earlier one."""
    lines = [x for x in t.split(b"\n") if x.strip(_SPACE)]
    return len(lines), len(lines) - len(set(lines))


def counts_of(texts: list[bytes]) -> dict[str, np.ndarray]:
    w = tx.words_of(texts)
    buf = np.frombuffer(w.data, dtype=np.uint8)
    length = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(np.append(0, length[:-1] + 1))
    out = {name: np.zeros(len(texts), dtype=np.int64) for name in COUNTS}
    # histogram of bytes by document, then sums over classes
    hist = np.stack([np.bincount(buf[a : a + n], minlength=256) for a, n in zip(first, length, strict=True)])
    sums = {name: hist @ table for name, table in _CLASSES.items()}
    for name in COUNTS:
        if name in sums:
            out[name] = sums[name]
    out["n_bytes"] = length
    out["n_words"] = np.diff(w.offsets)
    out["word_chars"] = length - sums["_later"] - sums["_space"]
    for d, t in enumerate(texts):
        out["n_lines"][d], out["n_dup_lines"][d] = _line_repeats(t)
        h = w.hashes[w.offsets[d] : w.offsets[d + 1]]
        if len(h) > 1:
            out["n_same_next"][d] = int((h[1:] == h[:-1]).sum())
        out["n_distinct"][d] = len(np.unique(h))
        if len(h) > 3:
            three = tx.rolling(h, 3)
            order = np.argsort(three, kind="stable")
            s = three[order]
            twin = np.zeros(len(s), dtype=bool)
            eq = s[1:] == s[:-1]
            twin[1:] |= eq
            twin[:-1] |= eq
            if twin.any():
                covered = np.zeros(len(h), dtype=bool)
                at = order[twin]
                covered[at] = covered[at + 1] = covered[at + 2] = True
                out["n_repeat_words"][d] = int(covered.sum())
    return out


def _stats(text: str, rest: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.texts_in(batch, text)
            for i, j in tx.slices(texts):
                found = counts_of(texts[i:j])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in rest), *(pa.array(found[n]) for n in COUNTS)], names=[*rest, *COUNTS])

    return run


def document_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs``, all but the text by default, with the counts.

    A column named like a count is replaced.
    """
    docs = docs.drop(*COUNTS)
    rest = [c for c in docs.columns if c != text] if keep is None else keep
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema]
    return docs.mapInArrow(_stats(text, rest), ", ".join([*fields, *(f"{n} long" for n in COUNTS)]))
