"""License scan: an Aho-Corasick automaton finds identifier tags and notice phrases
in the normalised words of a text; a shunting-yard parser evaluates the licence
expression (and / or / with, parentheses) that follows a tag.

Defined results: a null or empty text has no words, no places, empty label strings
and score 0; repeated rows each get their own row; a very long text is read whole, with
its expressions to the end of their line; an empty table gives an empty result; columns
of the input other than the id and the text are not read, so clashing names do no harm.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from duescore.llm.common import ALNUM, Words, slices

# The contract's notice phrases and labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases of this scan (words as the normaliser leaves them).
MORE_PHRASES = {
    "affero general public license": "agpl",
    "lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0 1 0": "cc0",
    "all rights reserved": "all-rights-reserved",
}
# Tags before a licence expression.
TAGS = ("spdx license identifier", "license identifier", "license expression")

# How free the use is under a licence family, from 0 to 1.
PERMISSION = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "bsl": 1.0, "cc0": 1.0, "cc-by": 0.9,
    "mpl": 0.7, "epl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3,
    "cc-by-nd": 0.2, "cc-by-nc": 0.2, "all-rights-reserved": 0.0,
}
UNKNOWN_PERMISSION = 0.1
EXCEPTION_BONUS = 0.2
TAG_WEIGHT, PHRASE_WEIGHT = 0.9, 0.6

#: What stands between a tag and its expression, and the next token on the same line.
LEAD = re.compile(r"[ \t\"']*[:=][ \t\"']*")
TOKEN = re.compile(r"[^\S\r\n]*([()]|[^\s()*/\"'<]+)")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def tokens(text: str, at: int) -> Iterator[str]:
    """The tokens from ``at`` to the end of the line, each read when it is asked for."""
    while m := TOKEN.match(text, at):
        yield m[1]
        at = m.end()


def parse_expression(text: str, at: int = 0) -> list[str] | None:
    """Reverse Polish form of the longest licence expression at place ``at`` of ``text``
    (shunting yard; with binds tighter than and, and tighter than or), or None."""
    out: list[str] = []
    ops: list[str] = []
    depth = 0
    best: tuple[int, list[str]] | None = None  # how much of ``out``, and the operators to come
    operand_next = True
    for tok in tokens(text, at):
        if operand_next:
            if tok == "(":
                ops.append(tok)
                depth += 1
                continue
            if tok == ")" or tok in PRECEDENCE or not re.fullmatch(r"[a-z0-9.+:\-]*[a-z0-9+][.,;]?", tok):
                break
            ended = tok[-1] in ".,;"
            out.append(tok.rstrip(".,;"))
            operand_next = False
        else:
            ended = False
            if tok == ")":
                if not depth:
                    break
                while ops[-1] != "(":
                    out.append(ops.pop())
                ops.pop()
                depth -= 1
            elif tok in PRECEDENCE:
                while ops and ops[-1] != "(" and PRECEDENCE[ops[-1]] >= PRECEDENCE[tok]:
                    out.append(ops.pop())
                ops.append(tok)
                operand_next = True
                continue
            else:
                break
        if not depth:
            best = len(out), ops[::-1]
        if ended:
            break
    return out[: best[0]] + best[1] if best else None


def family(ident: str) -> str:
    """The licence family of an identifier: the longest known family that starts it."""
    known = [f for f in PERMISSION if ident == f or ident.startswith(f + "-")]
    return max(known, key=len) if known else ident


def joined_parts(a: deque[str], between: str, b: deque[str]) -> deque[str]:
    """a, between, b in one: the shorter is moved to the longer."""
    if len(a) >= len(b):
        a.append(between)
        a.extend(b)
        return a
    b.appendleft(between)
    b.extendleft(reversed(a))
    return b


def evaluate(rpn: list[str]) -> tuple[float, str, set[str]]:
    """(permission, canonical text, labels): or takes the freer side, and the less
    free one, with adds an exception's freedom."""
    stack: list[tuple[float, deque[str], set[str]]] = []
    for tok in rpn:
        if tok not in PRECEDENCE:
            f = family(tok)
            stack.append((PERMISSION.get(f, UNKNOWN_PERMISSION), deque([tok]), {f}))
            continue
        b, a = stack.pop(), stack.pop()
        text = joined_parts(a[1], f" {tok} ", b[1])
        if tok == "with":
            stack.append((min(1.0, a[0] + EXCEPTION_BONUS), text, a[2]))
            continue
        text.appendleft("(")
        text.append(")")
        few, labels = sorted((a[2], b[2]), key=len)
        labels |= few
        stack.append(((max if tok == "or" else min)(a[0], b[0]), text, labels))
    permission, text, labels = stack[0]
    return permission, "".join(text), labels


def automaton(base: dict[str, str], more: dict[str, str], tags: tuple[str, ...]) -> ahocorasick.Automaton:
    """Patterns carry a space on both sides, so that only whole words match."""
    a = ahocorasick.Automaton()
    for kind, phrases in (("base", base), ("more", more), ("tag", dict.fromkeys(tags, ""))):
        for p, label in phrases.items():
            key = f" {p} "
            a.add_word(key, (*a.get(key, ()), (kind, label, len(p.split()), len(key))))
    a.make_automaton()
    return a


def scan_slice(ids: pa.Array, texts: pa.Array, auto: ahocorasick.Automaton, id_name: str) -> pa.RecordBatch:
    w = Words(texts, ALNUM)
    joined, starts, _ = w.joined()
    n = len(texts)
    counts = w.counts
    n_base = np.zeros(n, np.int64)
    first = np.full(n, -1, np.int64)
    last = np.full(n, -1, np.int64)
    base: dict[int, set[str]] = {}
    found: dict[int, list[tuple[str, float, float]]] = {}
    expressions: dict[int, list[str]] = {}
    # One string per row, a space at both ends; in Latin-1 a character is a byte.
    rows = np.flatnonzero(counts)
    for r in rows:
        lo, hi = w.row[r], w.row[r + 1]
        at = starts[lo]
        raw: str | None = None  # the whole row, once a tag is found
        text = " " + joined[at : (starts[hi] if hi < len(starts) else len(joined))].decode("latin-1") + " "
        for end, hits in auto.iter(text):
            for kind, label, size, width in hits:
                word = int(np.searchsorted(starts[lo:hi], at + end - width + 1))  # the pattern's first space stands before it
                if kind == "base":
                    n_base[r] += 1
                    first[r] = word if first[r] < 0 else min(first[r], word)
                    last[r] = max(last[r], word)
                    base.setdefault(r, set()).add(label)
                if kind != "tag":
                    found.setdefault(r, []).append((label, PHRASE_WEIGHT, PERMISSION[label]))
                    continue
                tail_at = int(w.ends[lo + word + size - 1])
                raw = w.low[w.offsets[r] : w.offsets[r + 1]].tobytes().decode("latin-1") if raw is None else raw
                m = LEAD.match(raw, tail_at - int(w.offsets[r]))
                rpn = parse_expression(raw, m.end()) if m else None
                if rpn:
                    permission, canonical, labels = evaluate(rpn)
                    expressions.setdefault(r, []).append(canonical)
                    found.setdefault(r, []).extend((x, TAG_WEIGHT / len(labels), permission) for x in sorted(labels))
    score = np.zeros(n)
    permission = np.full(n, np.nan)
    labels = [""] * n
    for r, hits in found.items():
        once = {label: max(x[1] for x in hits if x[0] == label) for label in {x[0] for x in hits}}
        score[r] = 1.0 - float(np.prod([1.0 - x for x in once.values()]))
        permission[r] = min(x[2] for x in hits)
        labels[r] = ",".join(sorted(once))
    none = n_base == 0
    return pa.RecordBatch.from_arrays(
        [
            ids, pa.array(counts.astype(np.int64)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
            pa.array([",".join(sorted(base.get(r, ()))) for r in range(n)], pa.string()), pa.array(labels, pa.string()),
            pa.array(score), pa.array([";".join(sorted(set(expressions.get(r, ())))) for r in range(n)], pa.string()),
            pa.array(permission, mask=np.isnan(permission)),
        ],
        names=[id_name, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "permission"],
    )


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] = BASE_PHRASES,
    more: dict[str, str] = MORE_PHRASES,
    tags: tuple[str, ...] = TAGS,
) -> DataFrame:
    """One row per input row: word count, places of base phrases, labels, score,
    canonical expressions after tags and the least permission found.  One narrow
    pass without a shuffle; an expression is read up to the end of its line, however
    long, and ends at its last complete part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(base, more, tags)
        for b in slices(batches, text_col):
            yield scan_slice(b.column(id_col), b.column(text_col), auto, id_col)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run,
        f"`{id_col}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, expressions string, permission double",
    )
