"""Operator 7: secret scanning by assignment-aware lexing.

Two kinds of finding.  Base findings are three fixed patterns (``assign``,
``access``, ``hex``).  The lexer adds ``literal`` findings: it reads source and
configuration syntax into name-literal pairs, carries constants along assignments, and
scores each literal by how sensitive the target name is and how random the literal looks.
Pairs are ``name = "text"``, ``"name": "text"``, ``name=value`` lines, ``export``/``set``
forms, subscripts (``config["name"] = ...``), calls (``set("name", ...)``), triple quotes,
lists of literals, ``+`` of literals and earlier names, a default after a call (``get() or
"text"``), values on the next, deeper indented line, indented blocks (``name: |``), elements
(``<name>text</name>``), and the password of a URL.  A quoted value may hold blanks under a
name of weight ``BLANKS_FROM``.

Results, per row: a null or empty text has no finding and keeps its row; spans are
code points, end exclusive; repeated rows give repeated results.  Texts are scanned
whole and a text's findings never depend on another text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in listing order and the least length of what counts.
KINDS = ("assign", "access", "hex", "literal")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = re.compile("(" + "|".join(map(_either_case, _KEYWORDS)) + ")"
                    + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)  # a maximal run, so the same as run then length

#: How sensitive a target name is, by the words in it.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9,
             "apikey": 1.0, "api_key": 1.0, "credential": 0.9, "private_key": 1.0, "privatekey": 1.0,
             "access_key": 0.9, "accesskey": 0.9, "auth": 0.6, "signing": 0.6}
LEAST_SCORE = 0.55
LEAST_LITERAL = 6
BLANKS_FROM = 0.9

_NAMES = re.compile("|".join(sorted(SENSITIVE, key=len, reverse=True)))
#: The sensitive words without separators, less those that hold another.
_JOINED = {w.replace("_", "") for w in SENSITIVE}
_JOINED = sorted(w for w in _JOINED if not any(o in w for o in _JOINED - {w}))
_NAME = r"[A-Za-z_][\w.\-]{0,99}"
#: name, then = := : or =>, then an expression up to the end of a statement; or a quoted name and a comma in a call.
_PAIR = re.compile(r"""(?:(?P<q>["'])(?P<quoted>%s)(?P=q)(?:[ \t]*\])?|(?P<name>[A-Za-z_$][\w.\-$]{0,99}))"""
                   r"""[ \t]*(?P<op>:=|=>|\+=|=(?!=)|:(?!:|//))[ \t]*"""
                   r"""|\([ \t]*(?P<cq>["'])(?P<called>%s)(?P=cq)[ \t]*(?P<comma>,)[ \t]*""" % (_NAME, _NAME))
_TERM = re.compile(r"""(?:[rbuf]{0,2})(?:\"{3}(?P<td>(?:[^"\\]|\\.|"(?!""))*)\"{3}|'{3}(?P<ts>(?:[^'\\]|\\.|'(?!''))*)'{3}"""
                   r"""|"(?P<d>(?:[^"\\\n]|\\.)*)"|'(?P<s>(?:[^'\\\n]|\\.)*)'"""
                   r"""|(?P<ref>[A-Za-z_$][\w.$]*)(?![\w.$(\-/+=]))""")
#: A call whose value a literal may replace.
_CALL = re.compile(r"[A-Za-z_$][\w.$]*\([^()\n]*\)")
_DEFAULT = re.compile(r"[ \t]*(?:or|\|\||\?\?)[ \t]*")
_OPEN, _COMMA = re.compile(r"[ \t]*[\[(][ \t]*"), re.compile(r"[ \t]*,[ \t]*(?=[rbuf]{0,2}[\"'])")
#: What follows a colon at the end of a line: deeper indented lines, after a block mark or not.
_BLOCK = re.compile(r"[|>][+\-]?[ \t]*\n(?P<lines>(?:[ \t]+\S[^\n]*(?:\n|\Z))+)")
_NEXT = re.compile(r"\r?\n[ \t]+(?=[^\s:]+[ \t]*(?:\r?\n|\Z)|[\"'])")
_ELEMENT = re.compile(r"<(?P<name>%s)(?:\s[^<>]{0,200})?>(?P<value>[^<>]+)</(?P=name)\s*>" % _NAME)
_URL = re.compile(r"(?<=[A-Za-z0-9+.\-])://[^\s:/@\"'<>]{1,99}:(?P<value>[^\s/@\"'<>]{1,199})@[\w\[]")
_BARE = re.compile(r"""[A-Za-z0-9+/_.=\-~!@%^*]+""")
_PLUS = re.compile(r"[ \t]*[+.][ \t]*(?=[\"'A-Za-z_$])|[ \t]+(?=[\"'])")
_PLACEHOLDER = re.compile(r"(?i)^(?:x{3,}|\*+|changeme|none|null|true|false|example\w*|your[\w-]*|<.*>|\$\{.*\}|todo)$")


def sensitivity(name: str) -> float:
    """Score in 0..1 of a target name; 0 for names that hold no sensitive word."""
    flat = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower().replace("-", "_").replace(".", "_")
    return max((SENSITIVE[m] for text in (flat, flat.replace("_", "")) for m in _NAMES.findall(text)), default=0.0)


def may_name(text: str) -> bool:
    """Whether a text may hold a name of some sensitivity: true wherever ``sensitivity`` of a part of it is not 0."""
    if not any(c in text for c in "=:(<"):
        return False
    flat = text.lower().replace("-", "").replace(".", "").replace("_", "")
    return any(word in flat for word in _JOINED)


def literal_weight(value: str, blanks: bool = False) -> float:
    """Score in 0..1 of how much a literal looks like a secret: length, entropy, mixed classes."""
    if len(value) < LEAST_LITERAL or _PLACEHOLDER.match(value) or (not blanks and any(c.isspace() for c in value)):
        return 0.0
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.3 + 0.1 * bits + 0.1 * classes)


Term = tuple[int, int, str]


def _terms(text: str, pos: int, known: dict[str, list[Term]]) -> tuple[list[Term], int, bool]:
    """Literals of an expression, where it ends, and whether all of them are quoted."""
    terms: list[Term] = []
    if call := _CALL.match(text, pos):
        default = _DEFAULT.match(text, call.end())
        if not default:
            return [], pos, False
        pos = default.end()
    opened = _OPEN.match(text, pos)
    if opened:
        pos = opened.end()
    while t := _TERM.match(text, pos):
        if t["ref"] is not None:
            if t["ref"] not in known:
                break
            terms += known[t["ref"]]
        else:
            kind = next(k for k in ("td", "ts", "d", "s") if t[k] is not None)
            terms.append((t.start(kind), t.end(kind), t[kind]))
        pos = t.end()
        more = _PLUS.match(text, pos) or (opened and _COMMA.match(text, pos))
        if not more:
            break
        pos = more.end()
    return terms, pos, bool(terms)


def lexed(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name, directly or through constants."""
    found: set[tuple[int, int]] = set()
    if "://" in text:
        found.update(m.span("value") for m in _URL.finditer(text) if not _PLACEHOLDER.match(m["value"]))
    if not may_name(text):
        return sorted(found)

    def note(target: float, terms: list[Term], quoted: bool) -> None:
        whole = "".join(t[2] for t in terms)
        if target and target * literal_weight(whole.strip(), quoted and target >= BLANKS_FROM) >= LEAST_SCORE:
            found.update((a, b) for a, b, _ in terms if b > a)

    if "</" in text:
        for m in _ELEMENT.finditer(text):
            note(sensitivity(m["name"]), [(*m.span("value"), m["value"])], True)
    known: dict[str, list[Term]] = {}
    at = 0
    while m := _PAIR.search(text, at):
        name, pos = m["quoted"] or m["name"] or m["called"], m.end()
        target = sensitivity(name)
        terms, pos, quoted = _terms(text, pos, known)
        if not terms and target and m["op"] == ":":
            if block := _BLOCK.match(text, m.end()):
                body = block["lines"].rstrip()
                begin = block.start("lines") + len(body) - len(body.lstrip())
                terms, pos, quoted = [(begin, block.start("lines") + len(body), body.strip())], block.start("lines") + len(body), True
            elif after := _NEXT.match(text, m.end()):
                terms, pos, quoted = _terms(text, after.end(), known)
                if not terms and (bare := _BARE.match(text, after.end())):
                    terms, pos = [(bare.start(), bare.end(), bare[0])], bare.end()
        if not terms and target and not m["comma"] and not _CALL.match(text, m.end()) and (bare := _BARE.match(text, m.end())):
            terms, pos = [(bare.start(), bare.end(), bare[0])], bare.end()
        if terms:
            note(target, terms, quoted)
            if not m["comma"]:
                known[name] = known.get(name, []) + terms if m["op"] == "+=" else terms
        else:
            known.pop(name, None)
        at = max(pos, m.end())
    return sorted(found)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base findings, sorted."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base findings and all findings of a text."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(base + [(a, 3, b) for a, b in lexed(text)])


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with each maximal covered run replaced by ``mark``; null stays null."""
    _, spans = scan(text)
    if not spans:
        return text
    out, at = [], 0
    end = -1
    for a, _, b in spans:
        if a > end:
            if end >= 0:
                out.append(mark)
                at = end
            out.append(text[at:a])
        end = max(end, b)
    out += [mark, text[end:]]
    return "".join(out)


def redacted(text: Column) -> Column:
    """A text column with every finding redacted."""
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(redact, na_action="ignore")

    return run(text)


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text in part:
                base, spans = scan(text)
                rows.append((*(sum(s[1] == k for s in base) for k in range(3)),
                             hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), run(F.col(text_col)).alias("_r"))
    return out.select("doc_id", *(F.col(f"_r.{c}") for c in
                                  ("n_assign", "n_access", "n_hex", "base_sha256", "spans")))
