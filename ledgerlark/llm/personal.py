"""Personal data in whole texts: Aho-Corasick anchors, expanded by local parsers.

One automaton finds the anchors of a text in one pass: at-signs, plus signs, digits, "://" and the
cue words of account numbers. Around an anchor a small deterministic parser looks for the borders
of what it announces and validates it, so that the work is linear in the text and no pattern is
tried where no anchor stands.

Base kinds, leftmost and not overlapping within a kind, failing matches dropped without retries:

* email `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`
* ip    `[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)`, parts at most 255
* card  `[0-9]([\\x20-]?[0-9])+`, 12 to 19 digits passing Luhn
* phone `\\+[0-9][\\x20().0-9-]+[0-9]`, 9 to 15 digits

Kinds the method adds; they never take the place of base spans:

* url     the address behind "://", scheme included, if it names a user before its host or its
          host is an address in brackets that holds two colons
* iban    country, check digits and 11 to 30 more letters or digits (blanks between), modulo 97 = 1,
          behind the cue IBAN
* account 6 to 20 letters or digits with at least four digits (points, hyphens or strokes between)
          behind a cue such as "account", "konto" or "passport" and at most twelve characters of
          punctuation or words like "no" and "number"; not where an iban stands

Spans are in code points, end exclusive, ordered by start, kind and end. Null and empty texts have
none. Rows stay as they are, repeated ones too; a carried column named `spans` is refused.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.llm.common import by_batch
from ledgerlark.session import tune

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account")
# Words that announce an account or document number.
CUES = (
    "account acct konto kontonummer kundennummer cuenta compte passport reisepass pasaporte passeport ssn "
    "social security insurance taxpayer"
).split()
SPANS = "spans array<struct<kind string, start int, end int>>"
SLICE_CHARS = 1 << 22

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_WORD = re.compile(r"\w")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"[0-9][ ().0-9-]+[0-9]")
_AUTHORITY = re.compile(r"(?:[A-Za-z0-9._~%!$&'()*+,;=:-]+@)?(?:\[[0-9A-Fa-f:.]+\]|[\w-]+(?:\.[\w-]+)*)(?::[0-9]+)?")
_REST = re.compile(r"[^\s<>\"']*")
_TAIL = ".,;:!?)]}"
_IBAN = re.compile(r"\W{0,4}([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30})")
_GAP = re.compile(r"(?:[ \t:#=.-]|no\b|nr\b|num\b|number\b|nummer\b|id\b|is\b){1,12}", re.IGNORECASE)
_ACCOUNT = re.compile(r"[A-Za-z0-9](?:[./-]?[A-Za-z0-9]){5,19}(?![A-Za-z0-9])")


@cache
def _anchors():
    """The automaton; its values are (what to parse, the anchor's length). One per worker process."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for sign, what in (("@", "email"), ("+", "phone"), ("://", "url"), *((d, "digit") for d in "0123456789")):
        made.add_word(sign, (what, len(sign)))
    for cue in ("iban", *CUES):
        for form in (cue, cue.capitalize(), cue.upper()):
            made.add_word(form, ("iban" if cue == "iban" else "account", len(cue)))
    made.make_automaton()
    return made


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        twice = int(digit) << (place & 1)
        total += twice - 9 if twice > 9 else twice
    return total % 10 == 0


def _email(text: str, at: int, low: int) -> tuple[int, int] | None:
    """The address around the at-sign at `at` that begins at `low` or later."""
    start = at
    while start > low and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def _addresses(text: str, start: int, numbers: str) -> list[tuple[int, int]]:
    """Runs of four numbers of a dotted chain, one behind the other, with parts of at most 255."""
    parts, out, at = numbers.split("."), [], start
    for first in range(0, len(parts) - 3, 4):
        four = parts[first : first + 4]
        size = sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
            out.append((at, at + size))
        at += size + 1
    return out


def _url(text: str, colon: int) -> tuple[int, int] | None:
    start = colon
    while start > 0 and text[start - 1] in _SCHEME and colon - start < 32:
        start -= 1
    host = _AUTHORITY.match(text, colon + 3)
    if start == colon or not host:
        return None
    own = host.group()
    if "@" not in own and not (own.startswith("[") and own.count(":") >= 2):
        return None
    end = _REST.match(text, host.end()).end()
    while end > host.end() and text[end - 1] in _TAIL:
        end -= 1
    return start, end


def iban_holds(code: str) -> bool:
    """Whether the check digits of an account code in letters and digits fit."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _iban(text: str, at: int) -> tuple[int, int] | None:
    """The longest code behind the cue whose check digits fit."""
    found = _IBAN.match(text, at)
    if not found:
        return None
    start, end = found.span(1)
    while len(code := text[start:end].replace(" ", "")) >= 15:
        if text[end - 1] != " " and not (end < len(text) and text[end].isalnum()) and iban_holds(code):
            return start, end
        end -= 1
    return None


def _account(text: str, at: int) -> tuple[int, int] | None:
    gap = _GAP.match(text, at)
    found = _ACCOUNT.match(text, gap.end()) if gap else None
    if found and sum(c in "0123456789" for c in found.group()) >= 4:
        return found.span()
    return None


def personal_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data in a text."""
    if not text:
        return []
    out, past_email, past_number, past_card, past_url, past_account = [], 0, 0, 0, 0, 0
    for end, (what, size) in _anchors().iter(text):
        at = end - size + 1
        if what == "digit":
            if at >= past_number:
                chain = _NUMBERS.match(text, at)
                past_number = chain.end()
                out += [("ip", *span) for span in _addresses(text, at, chain.group())]
            if at >= past_card:
                chain = _DIGITS.match(text, at)
                past_card = chain.end() if chain else at + 1
                if chain:
                    digits = chain.group().replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append(("card", *chain.span()))
        elif what == "email":
            if span := _email(text, at, past_email):
                past_email = span[1]
                out.append(("email", *span))
        elif what == "phone":
            found = _PHONE.match(text, at + 1)
            if found and 9 <= sum(c in "0123456789" for c in found.group()) <= 15:
                out.append(("phone", at, found.end()))
        elif what == "url":
            if at >= past_url and (span := _url(text, at)):
                past_url = span[1]
                out.append(("url", *span))
        elif at >= past_account and not (at and _WORD.match(text, at - 1)):
            found = _iban(text, end + 1) if what == "iban" else _account(text, end + 1)
            if found:
                past_account = found[1]
                out.append((what, *found))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _slices(texts: pa.Array):
    """Row ranges of about SLICE_CHARS characters, so that few texts are Python strings at a time."""
    low, size = 0, 0
    for row, text in enumerate(texts):
        size += 0 if not text.is_valid else text.as_buffer().size
        if size >= SLICE_CHARS:
            yield low, row + 1
            low, size = row + 1, 0
    if low < len(texts):
        yield low, len(texts)


_STRUCT = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _find(batch: pa.RecordBatch):
    texts = batch.column(0)
    for low, high in _slices(texts):
        found = [personal_spans(t) for t in texts.slice(low, high - low).to_pylist()]
        offsets = [0]
        for own in found:
            offsets.append(offsets[-1] + len(own))
        flat = [s for own in found for s in own]
        columns = [pa.array([s[k] for s in flat], _STRUCT[k].type) for k in range(3)]
        spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_STRUCT)))
        part = batch.slice(low, high - low)
        yield pa.RecordBatch.from_arrays([*part.columns[1:], spans], names=[*part.schema.names[1:], "spans"])


def find_personal(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """The columns `carry` of each document and `spans`, an array of (kind, start, end). No shuffle."""
    tune(docs.sparkSession)
    if "spans" in carry:
        raise ValueError("spans is the operator's own column")
    chosen = docs.select(F.col(f"`{text}`").cast("string").alias("_text"), *[F.col(f"`{c}`") for c in carry])
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[1:])
    return chosen.mapInArrow(by_batch(_find), f"{fields}{SPANS}")


def joined(spans: Column) -> Column:
    """`kind:start:end` of each span, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by `<KIND>` of its first one."""
    empty = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done, s):
        before = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        mark = F.when(s["start"] >= done["at"], F.concat(before, F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(F.lit(""))
        return F.struct(F.concat(done["out"], mark).alias("out"), F.greatest(done["at"], s["end"]).alias("at"))

    def rest(done):
        return F.concat(done["out"], F.substring(text, done["at"] + 1, F.greatest(F.length(text) - done["at"], F.lit(0))))

    return F.aggregate(spans, empty, step, rest)


def personal_digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [of(kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
