"""Token counts of fields and sections by offset-mapped attribution.

A document (its fields joined by line feeds) is encoded once, whole, so tokens are
those that training will see. Token spans follow from the bytes of the tokens;
they are joined to the section spans by interval (two binary searches per token),
and a token that crosses a section border is allocated by a stated rule:

* ``largest``: to the section that holds most of its bytes, ties to the earlier;
* ``first``: to the section that holds its first byte;
* ``share``: to every section by its share of the token's bytes.

Under each rule the counts of a document's sections sum to its token count. All
spans of a document are on its row, so nothing is shuffled.

Defined results: sections partition the document: a line keeps its line feed, and
the line feed that joins two fields belongs to the earlier one. A null field counts
as empty and is a section without characters; an empty field is one section, so
every document gives a row per field at least. Spans are in characters of the
joined document; a token that holds part of a character counts its bytes. Rows that
repeat an id give their rows again. Only the named columns are read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import Vocabulary, tokenizer_file, vocabulary

RULES = ("largest", "first", "share")
ROWS = "array<struct<field:string,section:int,start:int,end:int,n_tokens:double,n_crossing:long>>"


def line_ends(text: str) -> list[int]:
    """Ends of the lines of a text, line feeds included; one empty line for an empty text."""
    ends, at = [], text.find("\n") + 1
    while at:
        ends.append(at)
        at = text.find("\n", at) + 1
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return ends


@functools.lru_cache(maxsize=4)
def token_sizes(path: str) -> np.ndarray:
    return np.array([len(b) for b in vocabulary(path).token_bytes], np.int64)


def allocate(token_ends: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section and how many of them cross a border.

    ``token_ends``: ends of the tokens; ``borders``: ends of the sections, ascending, the last
    at the end of the document; both in bytes. Empty sections get none.
    """
    n = len(borders)
    counts, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not len(token_ends):
        return counts, crossing
    starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(borders, starts, side="right")
    last = np.searchsorted(borders, token_ends, side="left")
    counts += np.bincount(first[first == last], minlength=n)
    for t in np.flatnonzero(first != last).tolist():
        a, b = int(first[t]), int(last[t])
        cuts = np.concatenate([[starts[t]], borders[a:b], [token_ends[t]]])
        share = np.diff(cuts)
        crossing[a:b + 1] += share > 0
        if rule == "first":
            counts[a] += 1
        elif rule == "largest":
            counts[a + int(share.argmax())] += 1
        else:
            counts[a:b + 1] += share / share.sum()
    return counts, crossing


def window_ends(text: str, width: int) -> list[int]:
    """Ends of the windows of ``width`` characters of a text, the last one shorter; one for an empty text."""
    return [*range(width, len(text), width), len(text)]


def sections_of(fields: list[tuple[str, str]], by_line: set[str], widths: dict[str, int] | None = None) -> tuple[str, list[tuple[str, int, int]]]:
    """The joined document, and ``field, section number, end`` of its sections in order."""
    parts, sections, at = [], [], 0
    for k, (name, text) in enumerate(fields):
        if k < len(fields) - 1:
            text += "\n"
        width = (widths or {}).get(name)
        ends = window_ends(text, width) if width else line_ends(text) if name in by_line else [len(text)]
        sections += [(name, i, at + e) for i, e in enumerate(ends)]
        at += len(text)
        parts.append(text)
    return "".join(parts), sections


def count_tokens(docs: DataFrame, doc_id: str = "doc_id", fields: tuple[str, ...] = ("source", "lang", "text"),
                 by_line: tuple[str, ...] = ("text",), rule: str = "largest", path: str | None = None,
                 widths: dict[str, int] | None = None) -> DataFrame:
    """``doc_id, field, section, start, end, n_tokens, n_crossing``: one row per section. A field is one section,
    or its lines, or its windows of ``widths[field]`` characters."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    @F.arrow_udf(ROWS)
    def count(*columns: pa.Array) -> pa.Array:
        file = tokenizer_file(path)
        v: Vocabulary = vocabulary(file)
        sizes = token_sizes(file)
        documents = [sections_of([(n, x or "") for n, x in zip(fields, row)], set(by_line), widths)
                     for row in zip(*[c.to_pylist() for c in columns])]
        flat, each = v.encode_many([d for d, _ in documents])
        spans = sizes[flat]
        out, offsets, begin = {k: [] for k in ("field", "section", "start", "end", "n_tokens", "n_crossing")}, [0], 0
        for (text, sections), n in zip(documents, each.tolist()):
            ends = np.array([e for _, _, e in sections], np.int64)
            if not text.isascii():
                codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
                width = 1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int64) + (codes >= 0x10000)
                ends = np.concatenate([[0], np.cumsum(width)])[ends]
            counts, crossing = allocate(np.cumsum(spans[begin:begin + n]), ends, rule)
            begin += n
            out["field"] += [x for x, _, _ in sections]
            out["section"] += [x for _, x, _ in sections]
            out["start"] += [0, *[e for _, _, e in sections[:-1]]]
            out["end"] += [e for _, _, e in sections]
            out["n_tokens"] += counts.tolist()
            out["n_crossing"] += crossing.tolist()
            offsets.append(len(out["field"]))
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64())
        rows = pa.StructArray.from_arrays([pa.array(x, k) for x, k in zip(out.values(), kinds)], list(out))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    columns = [F.col(f).cast("string") for f in fields]
    return docs.select(F.col(doc_id).alias("doc_id"), F.inline(count(*columns)))
