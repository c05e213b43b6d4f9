"""Secret scans: fixed patterns plus automata inferred from the credentials they find.

One pass over the whole texts gives the base spans (assignments, access keys, long hex runs) and
every other candidate token. The values of the base spans are labelled credentials: a bounded
sample of them (``sample_values`` a kind, chosen by hash) trains one probabilistic automaton a
kind by grammar inference: a prefix tree of the character-class strings is built and states whose
outgoing frequencies are statistically compatible (Hoeffding bound) are merged with their
subtrees. A second automaton learns ordinary tokens (runs apart from the base spans) in the same
way and keeps words from being taken for keys. Every candidate is then scored on its whole value;
those that a credential format explains better by ``margin`` bits a character, and no worse than a
uniform choice of characters would, become further spans (kind ``format``). Base spans always stay.

Defined cases: NULL text counts as empty; a document without spans has an empty list and the
SHA-256 of the empty string; repeated rows are scanned each; positions are code points with
exclusive end; with no labelled credential nothing is added to the base spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import by_id, hash_below, map_texts, texts_of

KINDS = ("assign", "access", "hex")
SAMPLE_VALUES = 2_000
MARGIN_BITS = 1.0
#: Candidates are token runs at least as long as the shortest base value.
LEAST = 12

_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % LEAST)
_SMALL = re.compile(r"[a-z]")
_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return [(KINDS[k], a, b, v) for a, k, b, v in sorted(found)]


def candidates(text: str, base: list[tuple[str, int, int, str]]) -> list[tuple[int, int]]:
    """Whole token runs, also around or across base spans; a run inside one adds nothing to it."""
    out = []
    for m in _CANDIDATE.finditer(text):
        if not any(a <= m.start() and m.end() <= b for _, a, b, _ in base):
            out.append((m.start(), m.end()))
    return out


# Character classes in which automata read: digits, hex letters, other letters, each sign.
_CLASS = {**dict.fromkeys("0123456789", "d"), **dict.fromkeys("abcdef", "x"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "l"), **dict.fromkeys("ABCDEF", "X"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "U")}
#: Bits a character of a uniform choice among the characters of a candidate.
UNIFORM_BITS = math.log2(26 + 26 + 10 + 6)
_SIZE = {"d": 10, "x": 6, "l": 20, "X": 6, "U": 20}


def shape(value: str) -> str:
    return "".join([_CLASS.get(c, c) for c in value])


class Automaton:
    """Probabilistic automaton learned by state merging over a prefix tree (ALERGIA)."""

    def __init__(self, values: list[str], alpha: float = 0.05, depth: int = 48):
        self.count, self.stop, self.to, self.freq = [0], [0], [{}], [Counter()]
        self.depth = depth
        for value in sorted(values):
            s = 0
            self.count[0] += 1
            for c in shape(value)[:depth]:
                if c not in self.to[s]:
                    self.to[s][c] = len(self.count)
                    self.count.append(0), self.stop.append(0), self.to.append({}), self.freq.append(Counter())
                self.freq[s][c] += 1
                s = self.to[s][c]
                self.count[s] += 1
            self.stop[s] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        work = [(a, b)]
        while work:
            a, b = work.pop()
            n1, n2 = self.count[a], self.count[b]
            if not n1 or not n2 or a == b:
                continue
            if self._differ(self.stop[a], n1, self.stop[b], n2):
                return False
            for c in self.to[a].keys() | self.to[b].keys():
                if self._differ(self.freq[a][c], n1, self.freq[b][c], n2):
                    return False
                if c in self.to[a] and c in self.to[b] and len(work) < 10_000:
                    work.append((self.to[a][c], self.to[b][c]))
        return True

    def _fold(self, red: int, blue: int) -> None:
        """Add the subtree at ``blue`` (still a tree) into the automaton at ``red``."""
        work = [(red, blue)]
        while work:
            a, b = work.pop()
            self.count[a] += self.count[b]
            self.stop[a] += self.stop[b]
            for c, child in self.to[b].items():
                self.freq[a][c] += self.freq[b][c]
                if c in self.to[a]:
                    work.append((self.to[a][c], child))
                else:
                    self.to[a][c] = child

    def _merge_all(self, least: int = 8) -> None:
        red = [0]
        blue = [(0, c) for c in sorted(self.to[0])]
        while blue:
            blue.sort(key=lambda e: -self.count[self.to[e[0]][e[1]]])
            parent, c = blue.pop(0)
            state = self.to[parent][c]
            if state in red:
                continue
            # States met by few values carry no evidence of their own and join the first fit.
            into = next((r for r in red if self._compatible(r, state)), None)
            if into is None and self.count[state] < least:
                into = red[-1]
            if into is not None:
                self.to[parent][c] = into
                self._fold(into, state)
            else:
                red.append(state)
            blue = [(r, c) for r in red for c in sorted(self.to[r]) if self.to[r][c] not in red]
        self.states = len(red)

    def bits(self, value: str) -> float:
        """Bits a character that the automaton needs for ``value`` (smoothed)."""
        s, total = 0, 0.0
        text = shape(value)
        for c in text:
            n = self.count[s]
            total -= math.log2((self.freq[s][c] + 0.1) / (n + 4.0)) - math.log2(_SIZE.get(c, 1))
            s = self.to[s].get(c, 0)
        return total / max(len(text), 1)


class Formats:
    """The automata of all kinds and those of ordinary tokens: words, and tokens without small
    letters, which are too few among the others to be learned with them."""

    def __init__(self, labelled: dict[str, list[str]], ordinary: list[str]):
        self.kinds = {k: Automaton(v) for k, v in labelled.items() if v}
        # Without ordinary tokens the alternative is a uniform choice of characters.
        parts = [v for v in ordinary if _SMALL.search(v)], [v for v in ordinary if not _SMALL.search(v)]
        self.plain = [Automaton(p) for p in parts if p]

    def likely(self, value: str, margin: float = MARGIN_BITS) -> bool:
        if not self.kinds:
            return False
        plain = min((a.bits(value) for a in self.plain), default=6.0)
        # Of two models that both do not know a token (a word in capitals), none explains it.
        best = min(a.bits(value) for a in self.kinds.values())
        return best <= UNIFORM_BITS and best + margin <= plain


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and candidates of every whole text."""
    schema = (
        "doc_id long, base array<struct<kind:string,start:int,end:int,value:string>>, more array<struct<start:int,end:int,value:string>>"
    )
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
    runs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, more = [], []
        for t in texts_of(batch):
            spans = base_spans(t)
            base.append([dict(zip(("kind", "start", "end", "value"), s)) for s in spans])
            more.append([{"start": a, "end": b, "value": t[a:b]} for a, b in candidates(t, spans)])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, kinds), pa.array(more, runs)], ["doc_id", "base", "more"])

    return map_texts(by_id(docs), run, schema)


def train(scanned: DataFrame, *, sample_values: int = SAMPLE_VALUES) -> Formats:
    """Automata from at most about ``sample_values`` distinct values a kind and as many ordinary
    tokens with and without small letters, of a table made by :func:`scan`."""
    values = scanned.select(F.explode("base").alias("s")).select("s.kind", "s.value").distinct()
    # A run that overlaps a base span is no ordinary token.
    apart = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    plain = scanned.select(F.explode(apart).alias("s")).select(F.when(F.col("s.value").rlike("[a-z]"), "plain").otherwise("capitals").alias("kind"), "s.value").distinct()
    both = values.unionByName(plain)
    counts = {r["kind"]: r["n"] for r in both.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Formats({}, [])
    share = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, sample_values / n)))))
    picked = both.where(hash_below(F.col("value"), share[F.col("kind")], "secrets"))
    by: dict[str, list[str]] = {k: [] for k in (*KINDS, "plain", "capitals")}
    for r in picked.select("kind", F.substring("value", 1, 256).alias("value")).collect():
        by[r["kind"]].append(r["value"])
    return Formats({k: by[k] for k in KINDS}, by["plain"] + by["capitals"])


def label(scanned: DataFrame, formats: Formats, *, margin: float = MARGIN_BITS) -> DataFrame:
    """doc_id, counts, digest of the base spans and all spans of a scanned table."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string"

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans")}
            for base, more in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n = Counter(s["kind"] for s in base)
                for k in KINDS:
                    out[f"n_{k}"].append(n[k])
                named = [(s["start"], KINDS.index(s["kind"]), s["kind"], s["end"]) for s in base]
                out["base_sha256"].append(hashlib.sha256(_listed(named).encode()).hexdigest())
                added = [(s["start"], len(KINDS), "format", s["end"]) for s in more if formats.likely(s["value"], margin)]
                out["n_format"].append(len(added))
                out["spans"].append(_listed(sorted(named + added)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, pa.int64() if k[:2] == "n_" else pa.string()) for k, v in out.items())], ["doc_id", *out])

    return scanned.select("doc_id", "base", "more").mapInArrow(run, schema)


def _listed(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def redact_text(text: str, formats: Formats, mark: str = "[secret]", margin: float = MARGIN_BITS) -> str:
    """The text with every span (overlapping ones together) replaced by ``mark``."""
    base = base_spans(text)
    cuts = sorted([(a, b) for _, a, b, _ in base] + [(a, b) for a, b in candidates(text, base) if formats.likely(text[a:b], margin)])
    if not cuts:
        return text
    out, at = [], 0
    for a, b in cuts:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, formats: Formats, *, mark: str = "[secret]") -> DataFrame:
    """All documents and columns, secrets in ``text`` replaced; ``n_chars`` (where there is such a
    column) counts the new text. NULL texts stay NULL."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("text")
        new = [t if t is None else redact_text(t, formats, mark) for t in batch.column(at).to_pylist()]
        out = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
        k = out.schema.get_field_index("n_chars")
        if k >= 0:
            f = out.schema.field(k)
            out = out.set_column(k, f, pa.array([None if t is None else len(t) for t in new]).cast(f.type))
        return out

    return map_texts(docs, run, docs.schema)
