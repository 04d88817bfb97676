"""Secret scan: fixed token shapes, and literals that reach a sensitively named target.

The scan parses what looks like source or configuration into name-literal pairs: assignments,
mappings and settings of any common syntax, whatever stands between them. A value that is a name
passes on what that name holds, so a literal is judged by every name it reaches. Its score is the
sensitivity of the most sensitive such name times how much the literal looks like a secret.

Contract: null and empty texts have no spans; offsets are code points of the whole text, ends
exclusive; repeated rows are scanned each; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import texts

KINDS = ("assign", "access", "hex", "literal")
BASE_KINDS = KINDS[:3]
THRESHOLD = 0.7

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# How sensitive a part of a name is by itself, and what changes that.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pwd": 1.0, "pass": 0.8, "pw": 0.8,
    "secret": 1.0, "secrets": 1.0, "token": 0.9, "bearer": 0.9, "jwt": 0.9, "apikey": 1.0, "credential": 1.0,
    "credentials": 1.0, "creds": 1.0, "auth": 0.7, "authorization": 0.8, "signature": 0.6, "salt": 0.6, "key": 0.5,
    "webhook": 0.6, "connectionstring": 0.8, "dsn": 0.7,
}
LENGTHS = sorted({len(word) for word in SENSITIVE})
# Words that only end like a sensitive one.
ORDINARY = {
    "compass", "encompass", "bypass", "surpass", "trespass", "overpass", "underpass", "monkey", "donkey", "turkey",
    "hockey", "jockey", "whiskey", "hotkey", "lackey", "basalt",
}
SHARPENING = {"api", "access", "private", "secret", "encryption", "signing", "auth", "client", "master", "license", "ssh", "account"}
BLUNTING = {"file", "path", "url", "uri", "name", "id", "count", "length", "len", "size", "type", "field", "label", "hint", "policy", "limit", "expiry", "ttl", "public"}
HINT = re.compile(r"pass|pw|secret|token|bearer|jwt|key|cred|auth|signature|salt|web[\W_]?hook|connection|dsn", re.IGNORECASE)
PLACEHOLDER = re.compile(r"^(?:<.*>|\$?\{.*\}|%\(?\w+\)?s?|x+|\*+|\.+|your[-_ ].*|changeme|example.*|none|null|true|false|undefined)$", re.IGNORECASE)

TARGET = re.compile(
    r"""(?<![\w.$-])(?P<quote>["'`]?)(?P<name>[A-Za-z_$][\w.$-]*+)(?P=quote)(?:\[["'](?P<item>[\w.-]++)["']\])?[ \t]*"""
    r"""(?P<sign>:=|=>|:[ \t]*[A-Za-z_][\w\[\], ]{0,40}=|=(?![=~])|:(?!:))[ \t]*"""
)
STRING = re.compile(
    r"""[rbfuRBFU]{0,2}(?:\"{3}(?P<three>(?:[^"\\]++|\\[\s\S]|"(?!""))*+)\"{3}|'{3}(?P<triple>(?:[^'\\]++|\\[\s\S]|'(?!''))*+)'{3}"""
    r"""|"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`((?:[^`\\\n]|\\.)*)`)"""
)
MARGIN = re.compile(r"(?:\\?\s)*+")  # white space and continued lines at the start of a triple-quoted string
NAME = re.compile(r"[A-Za-z_$][\w.$]*+")
JOIN = re.compile(r"[ \t]*(?:\+|\.\.|&|\|\|)[ \t]*\n?[ \t]*")
BARE = re.compile(r"[^\s\"'`,;#]+(?=[ \t]*(?:[;,#]|$))", re.MULTILINE)
LINE_START = re.compile(r"[ \t]*(?:-[ \t]+)?(?:(?:export|set|setenv|env|ENV|ARG)[ \t]+)?(?:--?)?$")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    value_start: int
    value_end: int
    name: str | None
    score: float


def _words(parts: list[str]) -> Iterator[str]:
    """The sensitive words in a name's parts: parts, their ends, and neighbouring parts joined."""
    for i, part in enumerate(parts):
        if part not in ORDINARY:
            yield from (part[-n:] for n in LENGTHS if part[-n:] in SENSITIVE)
        joined = part
        for other in parts[i + 1 : i + LENGTHS[-1]]:
            joined += other
            if len(joined) > LENGTHS[-1] or min(len(part), len(other)) < 2:
                break
            if joined in SENSITIVE:
                yield joined


def name_score(name: str) -> float:
    """How sensitive a target's name is, from its parts; the last dotted part counts."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name.rsplit(".", 1)[-1])
    parts = [p.lower() for p in re.split(r"[^A-Za-z0-9]+", spaced) if p]
    found = [SENSITIVE[w] for w in _words(parts)]
    if not found:
        return 0.0
    score = max(found)
    if SHARPENING & set(parts):
        score = min(1.0, score + 0.4)
    return score * (0.2 if parts[-1] in BLUNTING or "public" in parts else 1.0)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret rather than a word or a placeholder."""
    if len(value) < 8 or len(set(value)) < 4 or PLACEHOLDER.match(value):
        return 0.0
    classes = sum(bool(re.search(c, value)) for c in ("[a-z]", "[A-Z]", "[0-9]", r"[^\w\s]"))
    return (0.5 if re.search(r"\s", value) else 1.0) * (0.75 if classes == 1 else 1.0)


def pairs(text: str) -> Iterator[tuple[str, list[tuple[int, int]], list[str]]]:
    """Name, literal spans and names used, for every assignment or setting in ``text``."""
    for match in TARGET.finditer(text):
        name = match["item"] or match["name"]
        literals: list[tuple[int, int]] = []
        used: list[str] = []
        near = max(0, match.start() - 40)
        line = text[max(near, text.rfind("\n", near, match.start()) + 1) : match.start()]
        setting = bool(LINE_START.match(line))
        at = match.end()
        while True:
            if string := STRING.match(text, at):
                start, end = string.span(string.lastindex)
                if string.lastgroup:  # triple quotes
                    start = MARGIN.match(text, start, end).end()
                    end = start + len(text[start:end].rstrip())
                literals.append((start, end))
                at = string.end()
            elif setting and not literals and not used and (bare := BARE.match(text, at)):
                (used if NAME.fullmatch(bare[0]) else literals).append(bare[0] if NAME.fullmatch(bare[0]) else bare.span())
                if used:
                    literals.append(bare.span())  # of an unquoted setting, unless it is a known name
                at = bare.end()
            elif word := NAME.match(text, at):
                used.append(word[0])
                at = word.end()
            else:
                break
            if not (more := JOIN.match(text, at)):
                break
            at = more.end()
        if literals or used:
            yield name, literals, used


def reached(text: str) -> dict[tuple[int, int], tuple[str, float]]:
    """Every literal with the most sensitive of all names it reaches through constants, and its score.

    Names are taken from the most sensitive down, equal ones by the alphabet; each claims, against
    the flow, what no name before it has claimed. So every name and every flow is walked once.
    """
    found = list(pairs(text))
    known = {name for name, literals, used in found if literals or used}
    flows: dict[str, set[str]] = defaultdict(set)
    direct: dict[tuple[int, int], set[str]] = defaultdict(set)
    for name, literals, used in found:
        for source in used:
            flows[source].add(name)
            if "." in source:
                flows[source.rsplit(".", 1)[-1]].add(name)
        for span in literals:
            if not (used and text[span[0] : span[1]] in known):
                direct[span].add(name)
    sources: dict[str, list[str]] = defaultdict(list)
    for source, targets in flows.items():
        for target in targets:
            sources[target].append(source)
    scores = {name: name_score(name) for name in known}
    rank, best = {}, {}
    for place, name in enumerate(sorted(known, key=lambda n: (-scores[n], n))):
        rank[name] = place
        todo = [name]
        while todo:
            if (at := todo.pop()) not in best:
                best[at] = name
                todo += sources.get(at, ())
    chosen = {span: min((best[name] for name in names), key=rank.get) for span, names in direct.items()}
    return {span: (name, scores[name]) for span, name in chosen.items()}


def scan(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All spans by start, then kind."""
    spans, lower = [], text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        spans += [Span("assign", *m.span(), *m.span(2), m[1], 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [Span("access", *m.span(), *m.span(), None, 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [Span("hex", *m.span(), *m.span(), None, 1.0) for m in HEX.finditer(text)]
    if ("=" in text or ":" in text) and HINT.search(text):
        base = sorted((s.start, s.end) for s in spans)
        starts, ends = [a for a, _ in base], list(accumulate((b for _, b in base), max, initial=-1))
        for (start, end), (name, sensitivity) in reached(text).items():
            score = sensitivity * literal_score(text[start:end])
            if score >= threshold and ends[bisect_right(starts, start)] < end:  # in no base span
                spans.append(Span("literal", start, end, start, end, name, score))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


FIELDS = "kind string, start int, end int, value_start int, value_end int, name string, score double"
SPAN_TYPE = f"array<struct<{FIELDS.replace(' string', ':string').replace(' int', ':int').replace(' double', ':double')}>>"
_ARROW = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value_start", pa.int32()), ("value_end", pa.int32()), ("name", pa.string()), ("score", pa.float64())]
    )
)


def find_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, spans``: every secret with its kind, place, value, target name and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[s._asdict() for s in scan(text, threshold)] for text in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(spans, type=_ARROW)], names=["doc_id", "spans"])

    return texts(docs).mapInArrow(run, f"doc_id long, spans {SPAN_TYPE}")


def redact_text(text: str, mark: str, threshold: float = THRESHOLD) -> str:
    """``text`` with every secret's value replaced by ``mark``; overlapping values are one."""
    out, at = [], 0
    for start, end in sorted((s.value_start, s.value_end) for s in scan(text, threshold)):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mark: str = "[SECRET]", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with secrets replaced; a null text stays null, all columns are kept."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if t is None else redact_text(t, mark, threshold) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(found, type=batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def listed(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of these kinds, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
