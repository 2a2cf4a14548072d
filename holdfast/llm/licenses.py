"""Licence scans: Aho-Corasick finds tags and notices, a shunting-yard parser evaluates expressions."""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import map_rows, query, table, utf8

# The phrases every scan must report, with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Further notices, as words, with their labels.
NOTICES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license version 2 0": "apache-2.0",
    "cc by 4 0": "cc-by-4.0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software": "isc",
}

# Identifiers of licence expressions, with their label and how much they ask of a user
# (0 nothing, 1 notice, 2 files stay open, 3 the work stays open).
IDENTIFIERS = {
    "0bsd": ("bsd", 0), "agpl-3.0": ("agpl", 3), "apache-1.1": ("apache", 1), "apache-2.0": ("apache", 1),
    "artistic-2.0": ("artistic", 1), "bsd-2-clause": ("bsd", 1), "bsd-3-clause": ("bsd", 1), "bsl-1.0": ("boost", 1),
    "cc-by-3.0": ("cc-by", 1), "cc-by-4.0": ("cc-by", 1), "cc-by-nc-4.0": ("cc-by-nc", 3), "cc-by-nd-4.0": ("cc-by-nd", 3),
    "cc-by-sa-3.0": ("cc-by-sa", 3), "cc-by-sa-4.0": ("cc-by-sa", 3), "cc0-1.0": ("cc0", 0), "cddl-1.0": ("cddl", 2),
    "epl-1.0": ("epl", 2), "epl-2.0": ("epl", 2), "eupl-1.2": ("eupl", 3), "gfdl-1.3": ("gfdl", 3),
    "gpl-1.0": ("gpl", 3), "gpl-2.0": ("gpl", 3), "gpl-3.0": ("gpl", 3), "isc": ("isc", 1),
    "lgpl-2.0": ("lgpl", 2), "lgpl-2.1": ("lgpl", 2), "lgpl-3.0": ("lgpl", 2), "mit": ("mit", 1), "mit-0": ("mit", 0),
    "mpl-1.1": ("mpl", 2), "mpl-2.0": ("mpl", 2), "ms-pl": ("ms-pl", 2), "ncsa": ("ncsa", 1), "ofl-1.1": ("ofl", 1),
    "openssl": ("openssl", 1), "osl-3.0": ("osl", 3), "postgresql": ("postgresql", 1), "psf-2.0": ("psf", 1),
    "python-2.0": ("psf", 1), "unicode-dfs-2016": ("unicode", 1), "unlicense": ("unlicense", 0), "upl-1.0": ("upl", 1),
    "vim": ("vim", 1), "w3c": ("w3c", 1), "wtfpl": ("wtfpl", 0), "x11": ("x11", 1), "zlib": ("zlib", 1),
}
#: An identifier that is not listed: nothing is known of it, so it may ask for everything.
OTHER = ("other", 3)
OWN_TERMS = re.compile(r"(?:licenseref|documentref)-.+")

TAG_WORDS = "spdx license identifier"
TAG = re.compile(rb"spdx-license-identifier:[ \t]*")
TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9][a-z0-9.+-]*)")
PRECEDENCE = {"with": 3, "and": 2, "or": 1}
#: How sure one piece of evidence makes the scan.
TAG_WEIGHT, NOTICE_WEIGHT, BASE_WEIGHT = 0.95, 0.8, 0.7

_KEPT = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


@functools.lru_cache(maxsize=1)
def _machine():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG_WORDS}:
        machine.add_word(f" {phrase} ", phrase)
    machine.make_automaton()
    return machine


def _operand(name: str):
    """Labels, what is asked, and whether the name is a licence for sure; None if it cannot be an identifier.

    Words of prose have no digits, signs or dots inside, unlisted identifiers do.
    """
    bare = name.removesuffix("-only").removesuffix("-or-later").removesuffix("+")
    if known := IDENTIFIERS.get(bare):
        return frozenset([known[0]]), float(known[1]), True
    if OWN_TERMS.fullmatch(name) or re.search(r"[0-9.+-]", bare):
        return frozenset([OTHER[0]]), float(OTHER[1]), bool(OWN_TERMS.fullmatch(name))
    return None


def parse_expression(data: bytes, start: int = 0, stop: int | None = None) -> tuple[str, frozenset, float] | None:
    """The longest licence expression at ``start``: its text, its labels, what it asks. It is read in place.

    Shunting-yard with WITH above AND above OR. AND asks for the most of its sides, OR lets the reader
    take the lesser, and an exception takes half a step off. An identifier that is not listed is an operand of
    its own, with the label ``other``, and asks for everything; an expression of nothing else is none, unless it
    names terms of its own (``licenseref-``). Dots that end a sentence are not part of a name. Reading stops at
    the first token that cannot go on and at a bracket that was never opened. None if there is no expression
    or a bracket stays open.
    """
    stop = len(data) if stop is None else stop
    output: list = []
    waiting: list[str] = []
    want_operand, spot, end, depth = True, start, start, 0
    exception = sure = False
    texts: list[str] = []

    def reduce_top() -> None:
        operator, right, left = waiting.pop(), output.pop(), output.pop()
        if operator == "with":
            output.append((left[0], max(0.0, left[1] - 0.5)))
        else:
            output.append((left[0] | right[0], (max if operator == "and" else min)(left[1], right[1])))

    while found := TOKEN.match(data, spot, stop):
        token = found[1].decode("ascii")
        token = token.rstrip(".") or token
        if want_operand:
            if token == "(" and not exception:
                waiting.append("(")
                depth += 1
            elif exception and token not in PRECEDENCE and token not in "()":
                output.append((frozenset(), 0.0))
                want_operand = exception = False
            elif token not in PRECEDENCE and token != ")" and not exception and (value := _operand(token)):
                output.append(value[:2])
                sure |= value[2]
                want_operand = False
            else:
                break
        elif token in PRECEDENCE:
            if token == "with" and (not texts or texts[-1] == ")"):
                break
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[token]:
                reduce_top()
            waiting.append(token)
            want_operand, exception = True, token == "with"
        elif token == ")" and depth:
            while waiting[-1] != "(":
                reduce_top()
            waiting.pop()
            depth -= 1
        else:
            break
        texts.append(token)
        spot = found.end()
        end = spot
    if want_operand and texts and texts[-1] in PRECEDENCE:  # an operator at the end belongs to the prose after it
        waiting.pop()
        texts.pop()
    elif want_operand:
        return None
    if depth:
        return None
    while waiting:
        reduce_top()
    return (" ".join(texts), *output[0]) if output and end > start and sure else None


def scan(text: str | None) -> tuple:
    """What one text says: words, base places, labels, score, expressions and the most that is asked."""
    data = utf8(text)
    words = data.translate(_KEPT).split()
    line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} " if words else ""
    places: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    doubt = 1.0
    tagged = False
    counted = before = 0  # words up to the last match that ended, which ends never go back behind
    for end, phrase in _machine().iter(line):
        before += line.count(" ", counted, end)
        counted = end
        if phrase in BASE:
            places.append(before - 1 - phrase.count(" "))
            base.add(BASE[phrase])
            doubt *= 1 - BASE_WEIGHT
        if phrase in NOTICES:
            labels.add(NOTICES[phrase])
            doubt *= 1 - NOTICE_WEIGHT
        tagged |= phrase == TAG_WORDS
    expressions: list[str] = []
    asked = None
    if tagged:
        lower, line_end = data.lower(), 0
        for tag in TAG.finditer(lower):
            if tag.end() >= line_end:
                line_end = lower.find(b"\n", tag.end()) % (len(lower) + 1)  # none: the end of the text
            if parsed := parse_expression(lower, tag.end(), line_end):
                expressions.append(parsed[0])
                labels |= parsed[1]
                asked = parsed[2] if asked is None else max(asked, parsed[2])
                doubt *= 1 - TAG_WEIGHT
    return (
        len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | labels)), 1 - doubt, expressions, asked,
    )


SCANNED = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
           "labels string, score double, expressions array<string>, asks double")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``, from its ``doc_id`` and whole ``text``; no shuffle.

    ``first_word`` and ``last_word`` are the first and last place of a base phrase, in words from 0.
    ``expressions`` are the licence expressions after identifier tags, in order, and ``asks`` is the most
    any of them asks of a user. A null or empty text has no words, no labels (an empty string) and score 0.
    Repeated rows are scanned each; other columns are not read.
    """

    def run(rows):
        for doc_id, text in rows:
            yield (doc_id, *scan(text))

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), SCANNED, run)


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
