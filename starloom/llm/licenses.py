"""License scans: Aho-Corasick over words and tags, a shunting-yard parser for expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import FOLD_ALNUM

#: Notice phrases, in words, and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Further notice phrases of the scan, in words, and their labels.
MORE_PHRASES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "public domain dedication": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
#: Tags that an expression follows, in words.
TAGS = ("spdx license identifier",)
#: Identifiers whose terms allow reuse with notice alone; others count as restricted.
PERMISSIVE = ("mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "unlicense", "cc0-1.0", "0bsd")

#: Identifiers that a tag may name, in lower case; exceptions that may follow `with`.
IDENTIFIERS = frozenset(
    """0bsd afl-3.0 agpl-1.0 agpl-1.0-only agpl-1.0-or-later agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0
    apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause
    bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0
    cc-by-4.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-3.0 cc-by-sa-4.0
    cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cpl-1.0 ecl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 gfdl-1.2 gfdl-1.3 gpl-1.0
    gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later isc
    lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only
    lgpl-3.0-or-later libpng-2.0 lppl-1.3c mit mit-0 mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0
    ofl-1.1 openssl osl-3.0 php-3.01 postgresql psf-2.0 python-2.0 ruby sleepycat unicode-3.0 unicode-dfs-2016
    unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1""".split()
)
EXCEPTIONS = frozenset(
    """autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 classpath-exception-2.0
    font-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 gpl-cc-1.0 libtool-exception linux-syscall-note
    llvm-exception ocaml-lgpl-linking-exception openjdk-assembly-exception-1.0 qt-lgpl-exception-1.1
    universal-foss-exception-1.0 wxwindows-exception-3.1""".split()
)
#: Names of a text's own, which no list can hold.
_OWN = re.compile(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")


def is_name(word: str, after_with: bool) -> bool:
    """Whether the piece, in lower case, names a licence (`+`: or any later version) or, behind `with`, an exception."""
    if after_with:
        return word in EXCEPTIONS
    return word.removesuffix("+") in IDENTIFIERS or _OWN.fullmatch(word) is not None


_EXPRESSION = re.compile(rb"[A-Za-z0-9.+()\-: \t]+")
_TAG_AT = re.compile(rb"spdx-license-identifier[ \t]*:", re.I)
_PIECE = re.compile(r"[()]|[A-Za-z0-9.+:\-]+")
#: Binding strength of the operators.
_BINDS = {"or": 1, "and": 2, "with": 3}


def to_postfix(expression: str) -> list[str] | None:
    """The expression's identifiers and operators in postfix order; None if it is malformed.

    Shunting-yard: `with` binds before `and`, `and` before `or`; equals bind to the left.
    """
    out: list[str] = []
    held: list[str] = []
    want_name = True
    for piece in _PIECE.findall(expression):
        word = piece.lower()
        if piece == "(":
            if not want_name:
                return None
            held.append(piece)
        elif piece == ")":
            if want_name:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif word in _BINDS:
            if want_name:
                return None
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[word]:
                out.append(held.pop())
            held.append(word)
            want_name = True
        else:
            if not want_name:
                return None
            out.append(word)
            want_name = False
    if want_name or "(" in held:
        return None
    return out + held[::-1]


def leading_expression(text: str) -> tuple[str, list[str]] | None:
    """The longest start of a line, in pieces, that is a well-formed expression, and its postfix form.

    One pass finds the last place at which what is read is well formed; no later one can be after the
    first piece that cannot stand where it does. A word that names no licence ends the expression, and
    so does one behind `with` that names no exception.
    """
    pieces = _PIECE.findall(text)
    end = depth = 0
    want_name = True
    before = ""
    for at, piece in enumerate(pieces, 1):
        # A name and an opening bracket stand where a name is wanted, all else where none is.
        starts = piece == "(" or piece != ")" and piece.lower() not in _BINDS
        if starts != want_name or piece == ")" and not depth:
            break
        if starts and (before == "with" if piece == "(" else not is_name(piece.lower(), before == "with")):
            break
        before = piece.lower()
        depth += (piece == "(") - (piece == ")")
        want_name = piece == "(" or piece.lower() in _BINDS
        if not want_name and not depth:
            end = at
    if not end:
        return None
    expression = " ".join(pieces[:end])
    return expression, to_postfix(expression)


def is_permissive(postfix: list[str], allowed: frozenset[str] = frozenset(PERMISSIVE)) -> bool:
    """Whether the terms can be met by permissive licences: `or` needs one side, `and` both.

    An exception after `with` only adds permissions, so the licence before it decides.
    """
    stack: list[bool] = []
    for piece in postfix:
        if piece in _BINDS:
            right, left = stack.pop(), stack.pop()
            stack.append(left or right if piece == "or" else left and right if piece == "and" else left)
        else:
            stack.append(piece.removesuffix("+") in allowed)
    return stack[0]


def automaton(phrases: dict[str, str], tags: tuple[str, ...] = TAGS) -> ahocorasick.Automaton:
    """One automaton over all phrases and tags; a blank on either side makes whole words."""
    machine = ahocorasick.Automaton()
    for phrase in [*phrases, *tags]:
        words = phrase.split()
        machine.add_word(f" {' '.join(words)} ", (phrase, len(words)))
    machine.make_automaton()
    return machine


def scan_text(data: bytes, machine: ahocorasick.Automaton) -> tuple[int, list[tuple[str, int]], list[str]]:
    """Number of words, the phrases found with the place of their first word, and tagged expressions."""
    words = data.translate(FOLD_ALNUM).split()
    # Latin-1 keeps a character for each byte, so any bytes can be searched.
    line = " " + b" ".join(words).decode("latin-1") + " "
    found: list[tuple[str, int]] = []
    place = counted = 0
    tagged = False
    for end, (phrase, n) in machine.iter(line):
        place += line.count(" ", counted, end)
        counted = end
        if phrase in TAGS:
            tagged = True
        else:
            found.append((phrase, place - n))
    expressions = []
    if tagged:
        tags = [(tag.start(), tag.end()) for tag in _TAG_AT.finditer(data)]
        # An expression ends at the next tag, so every byte is read once.
        for (_, start), (end, _) in zip(tags, [*tags[1:], (len(data), None)], strict=True):
            if (after := _EXPRESSION.match(data, start, end)) and (
                read := leading_expression(after[0].decode("ascii"))
            ):
                expressions.append(read[0])
    return len(words), found, expressions


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, expressions array<string>, permissive boolean, score double"
)


def scan_licenses(
    documents: DataFrame, base: dict[str, str] = BASE_PHRASES, more: dict[str, str] = MORE_PHRASES
) -> DataFrame:
    """Licence notices and tagged expressions of every document, one row each.

    n_base, first_word, last_word and base_labels tell of the base phrases alone: all places,
    the least and greatest word at which one starts, the labels. ``labels`` adds those of further
    phrases and the identifiers of tagged expressions; ``permissive`` is null without an
    expression, else whether all can be met by permissive licences. An expression holds listed
    identifiers, names of the form LicenseRef-..., and listed exceptions. The score is 0 without any
    notice, 0.5 with a phrase, 1 with a well-formed expression.

    Defined cases: a null text is an empty one; malformed expressions add no label; an expression of
    any length is read to the end of its line or the next tag; a null or repeated doc_id is an
    ordinary row; whole texts are read; other columns are ignored; an empty table gives an empty
    table.
    """
    phrases = {**base, **more}
    columns = [field.split()[0] for field in SCHEMA.replace("array<string>", "list").split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(phrases)
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, found, expressions = scan_text(data.as_py() or b"", machine)
                places = [at for phrase, at in found if phrase in base]
                base_labels = {base[phrase] for phrase, _ in found if phrase in base}
                read = [to_postfix(x) for x in expressions]
                names = {x for postfix in read for x in postfix if x not in _BINDS}
                labels = base_labels | {phrases[phrase] for phrase, _ in found} | names
                rows.append(
                    (
                        doc_id,
                        n,
                        len(places),
                        min(places, default=None),
                        max(places, default=None),
                        ",".join(sorted(base_labels)),
                        ",".join(sorted(labels)),
                        expressions,
                        all(is_permissive(x) for x in read) if read else None,
                        1.0 if expressions else 0.5 if found else 0.0,
                    )
                )
            yield pa.RecordBatch.from_pylist(
                [dict(zip(columns, row, strict=True)) for row in rows],
                pa.schema(
                    [
                        ("doc_id", pa.int64()),
                        ("n_words", pa.int64()),
                        ("n_base", pa.int64()),
                        ("first_word", pa.int64()),
                        ("last_word", pa.int64()),
                        ("base_labels", pa.string()),
                        ("labels", pa.string()),
                        ("expressions", pa.list_(pa.string())),
                        ("permissive", pa.bool_()),
                        ("score", pa.float64()),
                    ]
                ),
            )

    return documents.selectExpr("cast(doc_id as long) doc_id", "cast(text as binary) text").mapInArrow(scan, SCHEMA)
