"""Secret scans by assignment-aware lexing.

A text is read as source code or configuration: statements that give a name a value become name-literal pairs.
Constants are propagated, so that ``base = "ab12"; password = base + "cd34"`` pairs ``password`` with "ab12cd34",
by the nearest ``base`` set before it (or else the first after it); ``+=`` and ``.=`` add to what a name has.  A pair scores by how sensitive its target name is and by how much the
literal looks like a secret rather than a placeholder or prose.  Literals of a fixed format that tells what they
are, and passwords within URLs, name themselves.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ids, prepare, slices

MIN_SCORE = 0.5
MASK = "[SECRET]"

# every length is open; a name is tried from its first character only, and blanks are taken whole, so that a failure costs no second look
_TARGET = re.compile(
    r"""(?<![\w.$-])(?P<q>["']?)(?P<name>[A-Za-z_$][\w.$-]*)(?P=q)(?:\])?"""  # name, "name", ["name"]
    r"""(?:[ \t]*+:[ \t]*+[A-Za-z_][\w.\[\]]*+(?=[ \t]*+=[^=]))?"""  # a type
    r"""[ \t]*+(?P<op>=>|:=|\+=|\.=|=(?![=~>])|:(?![:=]))[ \t]*+""")
_STRING = re.compile(r'''(?P<kind>[rbufRBUF]{0,2})(?:"""(?P<d3>(?:[^\\]|\\.)*?)"""|"(?P<d>(?:[^"\\\n]|\\.)*)"|'(?P<s>(?:[^'\\\n]|\\.)*)'|`(?P<b>(?:[^`\\]|\\.)*)`)''', re.S)
_REF = re.compile(r"\$\{?([A-Za-z_][\w.]*)\}?|([A-Za-z_][\w.]*)(?![\w(\[])")
_BARE = re.compile(r"""[^\s"'`;,<>(){}\[\]]+""")
_JOIN = re.compile(r"[ \t]*(?:\\\n[ \t]*)?(?:\+|\.|(?=[\"']))[ \t]*(?:\\?\n[ \t]*)?")
_TAG = re.compile(r"<([A-Za-z_][\w.-]*)>([^<>\s][^<>\n]{3,}?)</\1>")
_URL = re.compile(r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]++://[^\s:/@]++:([^\s@/]{3,}+)@")
_BLOCK = re.compile(r"[|>][+-]?\d?[+-]?[ \t]*+\n")  # of YAML: the value is in the lines below, further in
_FIELDS = {"f": re.compile(r"\{([A-Za-z_][\w.]*)\}"), "$": re.compile(r"\$\{([A-Za-z_][\w.]*)\}")}  # what a string refers to
FORMATS = {
    "aws_access_key_id": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b", "github_token": r"\bgh[pousr]_[0-9A-Za-z]{36,}\b", "slack_token": r"\bxox[abpors]-[0-9A-Za-z-]{10,}",
    "google_api_key": r"\bAIza[0-9A-Za-z_-]{35}", "stripe_key": r"\b[sr]k_live_[0-9A-Za-z]{16,}", "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*-----END [A-Z ]*PRIVATE KEY-----",
    "json_web_token": r"\beyJ[\w-]{10,}\.eyJ[\w-]{10,}\.[\w-]{10,}",
}
_FORMAT = re.compile("|".join(f"(?P<{k}>{v})" for k, v in FORMATS.items()))
# what a text needs to hold for any of the above to match: cheap, in the JVM, ahead of the transfer to Python
_NEED = r"[=:]|</|AKIA|ASIA|gh[pousr]_|xox[abpors]-|AIza|k_live_|-----BEGIN|eyJ"

_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passwort": 1.0, "contraseña": 1.0, "secret": 1.0, "secrets": 0.9, "pwd": 0.9, "pass": 0.8, "token": 0.9, "apikey": 0.95, "accesskey": 0.95, "secretkey": 1.0, "privatekey": 1.0,
              "authtoken": 0.95, "accesstoken": 0.95, "credential": 0.8, "credentials": 0.8, "bearer": 0.8, "authorization": 0.8, "auth": 0.6, "jwt": 0.8, "otp": 0.6, "pin": 0.5, "salt": 0.6, "key": 0.45, "signature": 0.45}
_BEFORE_KEY = {"api": 0.95, "access": 0.95, "secret": 1.0, "private": 1.0, "encryption": 0.95, "signing": 0.95, "auth": 0.9, "account": 0.8, "storage": 0.8, "master": 0.9, "ssh": 0.95, "aws": 0.8, "license": 0.6}
_HARMLESS = {"id", "name", "count", "length", "len", "file", "path", "type", "field", "label", "hint", "prompt", "policy", "size", "limit", "max", "min", "expiry", "expires", "ttl", "url", "uri", "regex", "pattern", "column", "header", "public", "index", "version"}
_STANDS_FOR = ("change|changed|replace|replaced|insert|enter|put|add|set|use|your|you|my|our|the|some|any|this|that|with|and|for|here|there|goes|in|it|is|to|me|now|a|an|test|testing|dummy|fake|sample|example|placeholder|redacted|hidden|masked|"
               "removed|secret|password|passwd|passphrase|pass|pwd|token|key|api|auth|access|private|value|string|text|user|username|admin|name|none|null|nil|true|false|undefined|default|empty|todo|tbd|foo|bar|baz|na|env|var|config")
_PLACEHOLDER = re.compile(rf"(?i)^(?:x{{3,}}|\*{{2,}}|\.{{2,}}|-{{2,}}|_+|0+|(?:(?:{_STANDS_FOR})(?![a-z])|(?:{_STANDS_FOR})(?={_STANDS_FOR})|[\W_]|\d{{1,4}}(?!\d))++)$|^[<{{%\[].*[>}}%\]]$|^\$\{{?\w+\}}?$|\bexample\b|example$")


def name_score(name: str) -> float:
    """How sensitive a target name is, from its words (camelCase, snake_case, dots and dashes separate them)."""
    w = [x.lower() for x in _WORDS.findall(name)]
    best = max((_SENSITIVE.get(x, 0.0) for x in w), default=0.0)
    for a, b in zip(w, w[1:]):
        if b in ("key", "keys"):
            best = max(best, _BEFORE_KEY.get(a, 0.0))
    return best * 0.3 if w and w[-1] in _HARMLESS else best


def strength(literal: str, quoted: bool) -> float:
    """0 for placeholders, prose and what is too short; towards 1 with the literal's total entropy in bits."""
    n = len(literal)
    if n < 4 or _PLACEHOLDER.search(literal) or (quoted and " " in literal.strip() and not re.search(r"\d", literal)):
        return 0.0
    if not quoted and not re.search(r"\d|[A-Z].*[a-z]|[a-z].*[A-Z]|[^\w.-]", literal.strip(".-")):
        return 0.0  # a bare word
    h = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    return min(1.0, h * n / 40)


def _below(text: str, name: int, at: int) -> list[Part]:
    """The lines from ``at`` on that lie further in than the line of the name at ``name``, without their margins."""
    head = text[text.rfind("\n", 0, name) + 1 : name]
    margin, out = len(head) - len(head.lstrip(" ")), []
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        line = text[at:end]
        if line.strip():
            if len(line) - len(line.lstrip(" ")) <= margin:
                break
            a = at + len(line) - len(line.lstrip())
            out.append((True, line.strip(), a, a + len(line.strip())))
        at = end + 1
    return out


def _split(part: Part, kind: str, known) -> list[Part]:
    """A string's literals and the names that it refers to, if all of these are known."""
    _, literal, a, b = part
    found = list(_FIELDS[kind].finditer(literal))
    if not found or not all(m[1] in known for m in found):
        return [part]
    out, i = [], 0
    for m in found:
        out += [(True, literal[i : m.start()], a + i, a + m.start()), (False, m[1], a + m.start(), a + m.end())]
        i = m.end()
    return [p for p in [*out, (True, literal[i:], a + i, b)] if not p[0] or p[1]]


Part = tuple[bool, str, int, int]  # whether a literal; its text, or the name referred to; from, to


def _value(text: str, at: int, fields: dict[tuple[int, int], str] | None = None) -> tuple[list[Part], int, bool] | None:
    """The expression at ``at``: its parts, where it ends, and whether any of them is quoted.

    ``fields`` gets the spans of strings that may refer to names within, and how.
    """
    parts: list[Part] = []
    end, quoted = at, False
    while True:
        if m := _STRING.match(text, at):
            g = next(g for g in ("d3", "d", "s", "b") if m[g] is not None)
            parts.append((True, m[g], *m.span(g)))
            quoted = True
            if fields is not None and "{" in m[g]:
                fields[m.span(g)] = "f" if "f" in m["kind"].lower() else "$"
        elif (m := _REF.match(text, at)) and (parts or m[1] or not (b := _BARE.match(text, at)) or b.end() <= m.end() or text[m.end()] == "+"):
            parts.append((False, m[1] or m[2], *m.span()))
        elif not parts and (m := _BARE.match(text, at)):
            literal = m[0].rstrip(".")
            return [(True, literal, at, at + len(literal))], m.end(), False
        else:
            break
        end = m.end()
        j = _JOIN.match(text, end)
        if not j or (not j[0].strip() and not (quoted and text[j.end() : j.end() + 1] in ("'", '"'))):
            break
        at = j.end()
    return (parts, end, quoted) if parts else None


def scan(text: str | None, min_score: float = MIN_SCORE) -> list[tuple[str, int, int, float, str]]:
    """(name, start, end, score, literal) of each secret's literals, by position; start and end count characters."""
    if not text:
        return []
    pairs: list[tuple[str, list[Part], bool]] = []
    sets: dict[str, list[int]] = {}  # the pairs that set a name, in order
    fields: dict[tuple[int, int], str] = {}
    i = 0
    while m := _TARGET.search(text, i):
        i = m.end()
        if m["op"] == ":" and (below := _BLOCK.match(text, i)):
            i = below.end()
            if name_score(m["name"]) and (lines := _below(text, m.start(), i)):
                sets.setdefault(m["name"], []).append(len(pairs))
                pairs.append((m["name"], lines, True))
        elif v := _value(text, i, fields):
            parts = v[0]
            if m["op"] in ("+=", ".=") and m["name"] in sets:  # what the name had so far comes first
                parts = [(False, m["name"], *m.span("name")), *parts]
            sets.setdefault(m["name"], []).append(len(pairs))
            pairs.append((m["name"], parts, v[2]))
            i = v[1]
    if fields:
        pairs = [(name, [q for p in parts for q in (_split(p, fields[p[2:]], sets) if p[0] and p[2:] in fields else [p])], quoted) for name, parts, quoted in pairs]
    known: dict[int, bool] = {}  # whether all that a pair needs is set; those that it needs are seen to first

    def source(name: str, at: int) -> int | None:
        """The pair that sets ``name`` for pair ``at``: the nearest before it, or if there is none the first after it."""
        if name not in sets:
            return None
        j = bisect_left(sets[name], at)
        return sets[name][j - 1] if j else next((x for x in sets[name] if x != at), None)

    def solved(start: int) -> bool:
        todo, seen = [start], set()
        while todo:
            at = todo[-1]
            needs = [source(p[1], at) for p in pairs[at][1] if not p[0]]
            if at not in known and at not in seen:
                seen.add(at)
                todo += [x for x in needs if x is not None and x not in known and x not in seen]
                if todo[-1] != at:
                    continue
            todo.pop()  # a name that nothing sets, or a circle, can't be known
            known.setdefault(at, all(x is not None and known.get(x, False) for x in needs))
        return known[start]

    def literals_of(start: int) -> list[Part]:
        """The literals in order; beyond 10,000 steps each pair counts once, as doublings have no end."""
        out, seen, steps = [], set(), 0
        todo = [(start, p) for p in reversed(pairs[start][1])]
        while todo:
            at, p = todo.pop()
            steps += 1
            if p[0]:
                out.append(p)
            elif (x := source(p[1], at)) not in seen or steps < 10_000:
                seen.add(x)
                todo += [(x, q) for q in reversed(pairs[x][1])]
        return out

    found: dict[tuple[int, int], tuple[str, float, str]] = {}

    def add(name: str, a: int, b: int, score: float, literal: str) -> None:
        if score >= min_score and b > a and score > found.get((a, b), ("", 0.0))[1]:
            found[a, b] = (name, score, literal)

    def rate(s: float, literal: str, quoted: bool) -> float:
        return round(s * (0.3 + 0.7 * t), 4) if (t := strength(literal, quoted)) else 0.0

    for at, (name, parts, quoted) in enumerate(pairs):
        if not (s := name_score(name)):
            continue
        if solved(at):
            literals = literals_of(at)
            literal = "".join(p[1] for p in literals)
        elif len(parts) == 1 and source(parts[0][1], at) is None:  # a bare word that nothing sets is the literal
            literal = text[parts[0][2] : parts[0][3]]
            literals = parts = [(True, literal, *parts[0][2:])]
        else:
            continue
        score = rate(s, literal, quoted or not all(p[0] for p in parts))
        for _, _, a, b in literals:  # the constants that it is made of are secret where they are set
            add(name, a, b, score, literal)
    for m in _TAG.finditer(text):
        if s := name_score(m[1]):
            add(m[1], *m.span(2), rate(s, m[2], False), m[2])
    for m in _URL.finditer(text):
        add("url.password", *m.span(1), 0.0 if _PLACEHOLDER.search(m[1]) else 0.9, m[1])
    for m in _FORMAT.finditer(text):
        add(m.lastgroup, *m.span(), 0.0 if m[0].endswith("EXAMPLE") else 1.0, m[0])
    out, end = [], -1
    for (a, b), (name, score, literal) in sorted(found.items(), key=lambda x: (x[0][0], -x[0][1])):
        if a >= end:  # of nested spans the outer one
            out.append((name, a, b, score, literal))
            end = b
    return out


def redact(text: str | None, min_score: float = MIN_SCORE, mask: str = MASK) -> str | None:
    """The text with each secret's characters replaced by ``mask``."""
    if not text:
        return text
    out, i = [], 0
    for _, a, b, _, _ in scan(text, min_score):
        out += [text[i:a], mask]
        i = b
    return "".join([*out, text[i:]])


def suspect(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(_NEED), F.lit(False))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, name, start, end, score, length, digest): one row for each secret; its literal isn't repeated.

    start and end count characters of the text; digest is the literal's SHA-256, so that one secret can be traced
    through many documents.  Null and empty texts have none; repeated rows give repeated findings; rows without an
    id are left out; other columns are never read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [(i, n, s, e, x, len(v), hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for n, s, e, x, v in scan(t, min_score)]
            cols = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.string()))], ["doc_id", "name", "start", "end", "score", "length", "digest"])
    d = ids(docs, key, text).where(suspect(text)).select(F.col(key).cast("long").alias("doc_id"), text)
    return d.mapInArrow(run, "doc_id long, name string, start int, end int, score double, length int, digest string")


def redact_secrets(docs: DataFrame, text: str = "text", min_score: float = MIN_SCORE, mask: str = MASK) -> DataFrame:
    """The table with secrets masked in ``text``; all other columns as they are.

    Every row stays, with or without an id, and repeated ones too; null and empty texts stay as they are.
    """
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            yield pa.array([redact(x, min_score, mask) for x in t.to_pylist()], pa.string())
    prepare(docs.sparkSession)
    # only suspect texts go to Python; what comes back null is as it was
    return docs.withColumn(text, F.coalesce(F.arrow_udf(run, "string")(F.when(suspect(text), F.col(text))), F.col(text)))
