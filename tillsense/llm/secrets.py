"""Operator 7: secret scan with one combined automaton.

All rules are compiled into one minimal automaton (``automaton``). One pass
over the bytes of a batch of texts gives, for every rule, the positions where a
match ends. Texts without an event of a rule, nearly all, are done with it; in
the others the rule's spans are then read off exactly, leftmost first, and held
to the rule's length.

Kinds ``assign``, ``access`` and ``hex`` are fixed (leftmost, not overlapping
within their kind; matches that are too short use up their text but are
dropped). ``EXTRA`` rules are added to them: their spans come on top.

Defined cases: null text is the empty text, without spans; repeated rows are
separate rows; offsets count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsense.llm.automaton import Automaton, compile_rules, scan
from tillsense.llm.common import small_batches, text_batches, texts_of


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([_either(w) for w in ("password", "passwd", "secret", "token")] + [f"{_either('api')}_?{_either('key')}"])
_ASSIGN = rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?"
_VALUE = r"[A-Za-z0-9+/_.=-]"

KINDS = ("assign", "access", "hex")
#: What a kind's matches are before the length rule, and what is long enough.
BASE = {"assign": f"{_ASSIGN}({_VALUE}+)", "access": "AKIA([A-Z0-9]+)", "hex": "([0-9a-f]+)"}
LEAST = {"assign": (2, 8), "access": (0, 16), "hex": (0, 32)}
#: The same for the automaton; a short run of hex digits is an ordinary word.
EVENTS = {"assign": BASE["assign"], "access": BASE["access"], "hex": "[0-9a-f]{12,}"}
#: Further rules, as the automaton has them (lengths follow in the exact check:
#: counters of different rules would multiply its states).
EXTRA_EVENTS = {
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "prefixed": r"(gh[pousr]_|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]+",
}
EXTRA = {
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "prefixed": r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35,}",
}
RULES = {**EVENTS, **EXTRA_EVENTS}
_EXACT = {k: re.compile(p) for k, p in BASE.items()} | {k: re.compile(p) for k, p in EXTRA.items()}


def automaton() -> Automaton:
    return compile_rules(list(RULES.values()))


def spans_in(text: str, kinds: list[str]) -> list[tuple[int, int, str]]:
    """Exact spans of the ``kinds`` in a text in which the automaton has found them."""
    out = []
    for kind in kinds:
        group, least = LEAST.get(kind, (0, 0))
        out += [(m.start(), m.end(), kind) for m in _EXACT[kind].finditer(text) if m.end(group) - m.start(group) >= least]
    return out


def find_spans(texts: list[str], auto: Automaton) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) of every secret in each text, by start, then kind."""
    found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)  # no rule matches a line feed
    ends, bits = scan(auto, data)
    if not len(ends):
        return found
    last = np.cumsum([len(r) + 1 for r in raw])
    owner = np.searchsorted(last, ends, side="left")
    names = list(RULES)
    rank = {k: i for i, k in enumerate(names)}
    for i in np.unique(owner):
        seen = int(np.bitwise_or.reduce(bits[owner == i]))
        spans = spans_in(texts[i], [k for j, k in enumerate(names) if seen >> j & 1])
        found[i] = sorted(spans, key=lambda s: (s[0], rank[s[2]], s[1]))
    return found


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Every row's counts, digest of the base spans, and all spans."""

    small_batches(docs)
    auto = docs.sparkSession.sparkContext.broadcast(automaton())  # a few kB, whatever the corpus

    @F.pandas_udf("struct<n_assign long, n_access long, n_hex long, base_sha256 string, spans string>")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            rows = []
            for part in text_batches(pd.DataFrame({"text": texts_of(series)}, dtype=object)):
                for spans in find_spans(part["text"].tolist(), auto.value):
                    base = [s for s in spans if s[2] in BASE]
                    n = [sum(s[2] == k for s in base) for k in KINDS]
                    rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.withColumn("_s", scanned("text")).select("doc_id", "_s.*")
