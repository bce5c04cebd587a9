"""License scans: Aho-Corasick finds identifier tags and notice phrases; expressions after a tag go
through a shunting-yard parser.

Words are compared, not characters: A-Z are lower-cased and everything in ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
separates. One pass over the rows, no shuffle.

Defined cases: a null or empty text has no words and no labels; phrases may overlap, and each place
counts; an expression that can't be parsed gives the known names in it as labels and a lower score;
repeated rows and null ids are rows like others; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.tables import private, small_batches

# Notice phrases, as words, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "boost",
    "the unlicense": "unlicense",
    "all rights reserved": "proprietary",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
TAG = "spdx license identifier"
# Starts of identifiers in expressions, and their labels. ``identifiers`` of ``license_scan`` adds others.
IDENTIFIERS = {
    "0bsd": "bsd", "afl": "afl", "agpl": "agpl", "apache": "apache", "apsl": "apsl", "artistic": "artistic", "blueoak": "blueoak", "bsd": "bsd",
    "bsl": "boost", "busl": "busl", "cc-by": "cc-by", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-sa": "cc-by-sa", "cc0": "cc0",
    "cddl": "cddl", "cecill": "cecill", "cpl": "cpl", "curl": "curl", "ecl": "ecl", "epl": "epl", "eupl": "eupl", "gfdl": "gfdl", "gpl": "gpl",
    "hpnd": "hpnd", "ijg": "ijg", "ipl": "ipl", "isc": "isc", "lgpl": "lgpl", "libpng": "libpng", "lppl": "lppl", "mit": "mit", "mpl": "mpl",
    "ms-pl": "ms-pl", "ms-rl": "ms-rl", "mulanpsl": "mulanpsl", "ncsa": "ncsa", "odbl": "odbl", "ofl": "ofl", "openssl": "openssl", "osl": "osl",
    "pddl": "pddl", "php": "php", "postgresql": "postgresql", "psf": "psf", "python": "psf", "qpl": "qpl", "ruby": "ruby", "sleepycat": "sleepycat",
    "sspl": "sspl", "tcl": "tcl", "unicode": "unicode", "unlicense": "unlicense", "upl": "upl", "vim": "vim", "w3c": "w3c", "wtfpl": "wtfpl",
    "x11": "mit", "zlib": "zlib", "zpl": "zpl",
}
#: Labels under which a text may be used when an expression is evaluated.
OPEN = frozenset({
    "afl", "apache", "artistic", "blueoak", "boost", "bsd", "cc-by", "cc0", "curl", "ecl", "hpnd", "ijg", "isc", "libpng", "mit", "mulanpsl", "ncsa", "odbl", "ofl",
    "openssl", "pddl", "php", "postgresql", "psf", "ruby", "tcl", "unicode", "unlicense", "upl", "vim", "w3c", "wtfpl", "zlib", "zpl",
})

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, n_tags long, expressions string, usable boolean"
)
_WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_COLON = re.compile(r"\s*:")
_GAP = re.compile(r"[ \t]*")
#: A line's end, and what starts the next line of a comment.
_TURN = re.compile(r"[ \t\\]*(?:\r\n|\r|\n)[ \t]*(?:[*#;%!|]+|//+|--+)?[ \t]*")
_RANK = {"OR": 1, "AND": 2, "WITH": 3}


@dataclass(frozen=True)
class Expression:
    """A parsed license expression: labels in it, whether it allows use, whether it is well formed."""

    labels: frozenset[str]
    usable: bool
    valid: bool


def identifier_label(name: str, identifiers: dict[str, str] = IDENTIFIERS) -> str | None:
    """The label of the longest known start of a name that ends where a part of the name does."""
    low = name.lower()
    parts = [i for i in range(len(low), 0, -1) if i == len(low) or not (low[i - 1].isalpha() and low[i].isalpha())]
    return next((identifiers[low[:i]] for i in parts if low[:i] in identifiers), None)


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting yard: operators after their operands; None if brackets or operands don't fit."""
    out, waiting, operand = [], [], False
    for token in tokens:
        kind = token.upper() if token.upper() in _RANK else token
        if kind in _RANK:
            if not operand:
                return None
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[kind]:
                out.append(waiting.pop())
            waiting.append(kind)
            operand = False
        elif token == "(":
            if operand:
                return None
            waiting.append(token)
        elif token == ")":
            if not operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        else:
            if operand:
                return None
            out.append(token)
            operand = True
    if not operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def expression_at(text: str) -> list[str]:
    """Tokens of the longest expression that starts a text.

    It ends where the next token doesn't fit, so what follows in a comment isn't part of it. It goes on over a line's end where
    an operand or a bracket is still due, and where the next line starts with an operator in capitals.
    """
    tokens: list[str] = []
    at, depth, due = 0, 0, True
    while True:
        turn = _TURN.match(text, at)
        found = _TOKEN.match(text, (turn or _GAP.match(text, at)).end())
        if found is None:
            return tokens
        token = found[0]
        operator = token.upper() in _RANK
        if turn and not due and depth == 0 and not (operator and token.isupper()):
            return tokens
        if due:
            if operator or token == ")":
                return tokens
            depth += token == "("
            due = token == "("
        elif token == ")" and depth:
            depth -= 1
        elif operator:
            due = True
        else:
            return tokens
        tokens.append(token)
        at = found.end()


def evaluate(text: str, identifiers: dict[str, str] = IDENTIFIERS) -> Expression:
    """OR allows use if one side does, AND if both do; an exception (WITH) leaves its license's answer."""
    tokens = _TOKEN.findall(text)
    known = frozenset(x for x in (identifier_label(t, identifiers) for t in tokens) if x)
    order = postfix(tokens)
    if order is None:
        return Expression(known, False, False)
    stack: list[tuple[frozenset[str], bool]] = []
    for token in order:
        if token in _RANK:
            (right, allowed), (left, allows) = stack.pop(), stack.pop()
            stack.append((left, allows) if token == "WITH" else (left | right, allows or allowed if token == "OR" else allows and allowed))
        else:
            label = identifier_label(token, identifiers)
            stack.append((frozenset({label} if label else ()), label in OPEN))
    return Expression(*stack[0], valid=True)


def tagged(data: bytes, ends: list[int]) -> list[str]:
    """The expressions behind tags, given the number of each tag's last word. Words and bytes of a text keep their places."""
    spans = [m.end() for m in _WORD.finditer(data.translate(_WORD_BYTES))]
    out = []
    for number in ends:
        rest = data[spans[number] :].decode("utf-8", "replace")
        if colon := _COLON.match(rest):
            out.append(" ".join(expression_at(rest[colon.end() :])))
    return out


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    kinds = [(p, "base", x) for p, x in BASE_PHRASES.items()] + [(p, "more", x) for p, x in MORE_PHRASES.items()] + [(TAG, "tag", "")]
    for phrase, kind, label in kinds:
        found.add_word(f" {phrase} ", (kind, label, len(phrase) + 2))
    found.make_automaton()
    return found


def scan_text(found: ahocorasick.Automaton, data: bytes, identifiers: dict[str, str] = IDENTIFIERS) -> tuple:
    """One result row without its doc_id, for a text in UTF-8."""
    words = data.translate(_WORD_BYTES).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    places, base, more, tags, word, at = [], set(), set(), [], -1, 0
    for end, (kind, label, size) in sorted(found.iter(line), key=lambda x: x[0] - x[1][2]):
        start = end - size + 1
        word, at = word + line.count(" ", at, start + 1), start + 1
        if kind == "base":
            places.append(word)
            base.add(label)
        elif kind == "more":
            more.add(label)
        else:
            tags.append(word + len(TAG.split()) - 1)
    shown = tagged(data, tags) if tags else []
    parsed = [evaluate(x, identifiers) for x in shown]
    labels = base | more | {label for x in parsed for label in x.labels}
    if not labels:
        score = 0.0
    elif parsed:
        score = 1.0 if all(x.valid for x in parsed) else 0.6
    else:
        score = min(0.9, 0.5 + 0.1 * (len(places) + len(more)))
    usable = all(x.usable for x in parsed) if parsed else bool(labels) and labels <= OPEN
    return (
        len(words), len(places), places[0] if places else None, places[-1] if places else None,
        ",".join(sorted(base)), ",".join(sorted(labels)), score, len(tags), "; ".join(shown), usable,
    )


def license_scan(docs: DataFrame, identifiers: dict[str, str] | None = None) -> DataFrame:
    """One row per document with its notices, tags and what their expressions allow. identifiers: further starts of names in
    lower case and their labels, for instance from a published list."""
    known = IDENTIFIERS | (identifiers or {})
    names = [x.split()[0] for x in SCHEMA.split(", ")][1:]
    types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.int64(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows = [scan_text(found, x.as_py() or b"", known) for x in texts]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            arrays = [pa.array(x, t) for x, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *arrays], names=["doc_id", *names])

    return private(small_batches(docs), doc_id="doc_id", text="text").mapInArrow(run, SCHEMA)
