"""Personal data by anchor expansion: one automaton finds anchors, local parsers expand them."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("url", "account", "address")

DIGITS = frozenset(string.digits)
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
LABEL = frozenset(string.ascii_letters + string.digits + "-")
PHONE_BODY = frozenset(string.digits + " ().-")
URL_BODY = frozenset(string.ascii_letters + string.digits + "-._~:/?#[]@!$&'()*+,;=%")
WORD = frozenset(string.ascii_letters + string.digits)

SCHEMES = ("http://", "https://", "ftp://")
ACCOUNT_CUES = (
    "account", "acct", "account no", "account number", "routing number", "ssn", "passport", "token", "api_key", "api key", "secret", "password",
    "konto", "kontonummer", "steuernummer", "passwort", "compte", "mot de passe", "cuenta", "contraseña", "dni",
)
IBAN_CUES = ("iban",)
# Street words by where the number and the name stand: `12 Elm street`, `12 rue X`, `calle X 12`, `Elmstraße 12`.
STREETS_AFTER = ("street", "avenue", "road", "lane", "boulevard", "drive", "court")
STREETS_BEFORE = ("rue", "avenue", "boulevard", "chemin", "impasse")
STREETS_FIRST = ("calle", "avenida", "plaza", "paseo")
STREETS_WITHIN = ("straße", "strasse", "gasse", "allee", "platz")
#: Letters before `straße` in one word; looked back for at every cue, so few.
LONGEST_NAME = 40
#: Fixed value: most characters of an IBAN.
IBAN_LONGEST = 34

SPANS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
REDACTED = "text string"


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Anchors: at-sign, plus, digits, schemes, identifier cues and street words, matched on lowered text."""
    found = ahocorasick.Automaton()
    for digit in string.digits:
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for kind, cues in (("scheme", SCHEMES), ("account", ACCOUNT_CUES), ("iban", IBAN_CUES)):
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    for cue in {*STREETS_AFTER, *STREETS_BEFORE, *STREETS_FIRST, *STREETS_WITHIN}:
        found.add_word(cue, ("street", len(cue)))
    found.make_automaton()
    return found


def folded(text: str) -> str:
    """`text` lowered with every code point at its place."""
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else text.translate(ASCII_FOLD)


ASCII_FOLD = {ord(c): c.lower() for c in string.ascii_uppercase}


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around an at-sign: local characters back to `floor`, then dotted labels."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    if start == at:
        return None
    end, labels, size = at + 1, 0, len(text)
    while True:
        stop = end
        while stop < size and text[stop] in LABEL:
            stop += 1
        if stop == end:
            break
        labels, last = labels + 1, stop
        if stop < size and text[stop] == ".":
            end = stop + 1
        else:
            break
    return (start, last) if labels >= 2 else None


def ip_from(text: str, start: int) -> tuple[bool, int]:
    """Four dotted digit runs from `start`: whether they stand there, and where they end."""
    end, size, parts = start, len(text), 0
    while True:
        while end < size and text[end] in DIGITS:
            end += 1
        parts += 1
        if parts == 4:
            return True, end
        if end + 1 < size and text[end] == "." and text[end + 1] in DIGITS:
            end += 1
        else:
            return False, end


def card_end(text: str, start: int) -> int:
    """End of the longest run of digits with single spaces or hyphens between them."""
    end, size = start + 1, len(text)
    while end < size:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < size and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    return end


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def phone_end(text: str, plus: int) -> int | None:
    """End of `+`, a digit, body characters and a last digit; None where none is."""
    size, end = len(text), plus + 2
    if plus + 1 >= size or text[plus + 1] not in DIGITS:
        return None
    while end < size and text[end] in PHONE_BODY:
        end += 1
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return end if end > plus + 3 and text[end - 1] in DIGITS else None


def url_from(text: str, start: int, body: int) -> int | None:
    """End of a URL whose host follows at `body`: dotted labels or one label with a port or path."""
    size, end = len(text), body
    while end < size and text[end] in URL_BODY:
        end += 1
    while end > body and text[end - 1] in ".,;:!?)'":
        end -= 1
    return end if end > body and text[body] in LABEL else None


def account_after(text: str, cue_end: int) -> tuple[int, int] | None:
    """The identifier after a cue: up to 6 separators, then 8 to 64 letters and digits with a digit.

    Single spaces and hyphens between groups of digits belong to it, so that account
    boundaries are those of the whole number.
    """
    size, start = len(text), cue_end
    while start < size and start - cue_end < 6 and text[start] in " :=\"'#-":
        start += 1
    if start == cue_end or start >= size:
        return None
    end = start
    while end < size:
        if text[end] in WORD:
            end += 1
        elif text[end] in " -" and end + 1 < size and text[end + 1] in DIGITS and text[end - 1] in DIGITS:
            end += 1
        else:
            break
    kept = [c for c in text[start:end] if c in WORD]
    return (start, end) if 8 <= len(kept) <= 64 and sum(c in DIGITS for c in kept) >= 4 else None


def iban_after(text: str, cue_end: int) -> tuple[int, int] | None:
    """The longest IBAN after a cue: letters and digits, in groups by single spaces, whose remainder is 1."""
    size, start = len(text), cue_end
    while start < size and start - cue_end < 6 and text[start] in " :=.#-":
        start += 1
    end, found, plain = start, None, ""
    while end < size and len(plain) < IBAN_LONGEST and (text[end] in WORD or text[end] == " " and end + 1 < size and text[end + 1] in WORD):
        if text[end] in WORD:
            plain += text[end].upper()
            last = end + 1 == size or text[end + 1] not in WORD
            if last and len(plain) >= 15 and plain[:2].isalpha() and plain[2:4].isdigit() and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                found = start, end + 1
        end += 1
    return found


def names_and_number(text: str, place: int) -> int | None:
    """End of one to four words and a house number that stand at `place`, each after a space."""
    end, words = place, 0
    while words < 5 and end + 1 < len(text) and text[end] == " ":
        stop = end + 1
        while stop < len(text) and (text[stop].isalnum() or text[stop] == "'"):
            stop += 1
        word = text[end + 1 : stop]
        if words and word and all(c in DIGITS for c in word):
            return stop if len(word) <= 5 else None
        if not word or word[0] in DIGITS:
            return None
        end, words = stop, words + 1
    return None


def house_number(text: str, end: int) -> int | None:
    """Start of a house number of up to five digits that ends before the space or comma at `end`."""
    start = end
    while start > 0 and text[start - 1] in DIGITS:
        start -= 1
    return start if 0 < end - start <= 5 and (start == 0 or text[start - 1] in " \n,(") else None


def address_around(text: str, lowered: str, cue: int, cue_end: int) -> tuple[int, int] | None:
    """The address around a street word, by where its language puts the number and the name."""
    word = lowered[cue:cue_end]
    apart = cue == 0 or not text[cue - 1].isalnum()
    if word in STREETS_WITHIN:
        start = cue
        while start > 0 and text[start - 1].isalpha() and cue - start < LONGEST_NAME:
            start -= 1
        stop = cue_end + 1
        while stop < len(text) and text[stop] in DIGITS and stop - cue_end <= 5:
            stop += 1
        whole = text[cue_end : cue_end + 1] == " " and stop > cue_end + 1 and (stop == len(text) or not text[stop].isalnum())
        return (start, stop) if whole and start < cue else None
    if not apart or cue_end < len(text) and text[cue_end].isalnum():
        return None
    if word in STREETS_AFTER and (span := address_before(text, cue, cue_end)):
        return span
    if word in STREETS_FIRST and (end := names_and_number(text, cue_end)):
        return cue, end
    if word in STREETS_BEFORE and cue > 1 and text[cue - 1] == " ":
        number_end = cue - 2 if text[cue - 2] == "," else cue - 1
        start, end = house_number(text, number_end), cue_end
        for _ in range(3):  # up to three words of the name
            stop = end + 1
            while stop < len(text) and (text[stop].isalpha() or text[stop] in "'-"):
                stop += 1
            if end >= len(text) or text[end] != " " or stop == end + 1:
                break
            end = stop
        return (start, end) if start is not None and end > cue_end else None
    return None


def address_before(text: str, cue: int, cue_end: int) -> tuple[int, int] | None:
    """A house number and one to four words before a street cue."""
    if cue_end < len(text) and text[cue_end] in WORD or cue == 0 or text[cue - 1] != " ":
        return None
    start, words = cue - 1, 0
    while words < 5 and start > 0:
        stop = start
        while start > 0 and text[start - 1] in WORD:
            start -= 1
        if start == stop:
            return None
        if words and all(c in DIGITS for c in text[start:stop]) and stop - start <= 5:
            return (start, cue_end) if start == 0 or text[start - 1] in " \n,(" else None
        words += 1
        if start == 0 or text[start - 1] != " ":
            return None
        start -= 1
    return None


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data in `text`, by kind as listed, then start.

    Base kinds are the leftmost non-overlapping matches of their patterns, those that fail
    their check dropped. The other kinds come from schemes and cues; they never take a base
    span away.
    """
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    free = dict.fromkeys(("email", "ip", "card", "phone", "url", "account", "address"), 0)
    lowered = folded(text)
    for last, (anchor, length) in automaton().iter(lowered):
        start = last - length + 1
        if anchor == "digit":
            if start >= free["ip"]:
                whole, free["ip"] = ip_from(text, start)
                if whole and all(int(p) <= 255 if len(p) <= 12 else int(p.lstrip("0")[:4] or 0) <= 255 for p in text[start : free["ip"]].split(".")):
                    found["ip"].append((start, free["ip"]))
            if start >= free["card"]:
                free["card"] = end = card_end(text, start)
                digits = text[start:end].replace(" ", "").replace("-", "") if end - start <= 37 else ""
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append((start, end))
        elif anchor == "at":
            if start >= free["email"] and (span := email_at(text, start, free["email"])):
                found["email"].append(span)
                free["email"] = span[1]
        elif anchor == "plus":
            if start >= free["phone"] and (end := phone_end(text, start)):
                free["phone"] = end
                if 9 <= sum(c in DIGITS for c in text[start:end]) <= 15:
                    found["phone"].append((start, end))
        elif anchor == "scheme":
            if start >= free["url"] and (end := url_from(text, start, last + 1)):
                found["url"].append((start, end))
                free["url"] = end
        elif anchor == "account":
            if start >= free["account"] and (start == 0 or text[start - 1] not in WORD):
                if span := account_after(text, last + 1):
                    found["account"].append(span)
                    free["account"] = span[1]
        elif anchor == "iban":
            if start >= free["account"] and (start == 0 or text[start - 1] not in WORD) and (span := iban_after(text, last + 1)):
                found["account"].append(span)
                free["account"] = span[1]
        elif start >= free["address"] and (span := address_around(text, lowered, start, last + 1)):
            if span[0] >= free["address"]:
                found["address"].append(span)
                free["address"] = span[1]
    return [(kind, start, end) for kind in KINDS for start, end in found[kind]]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """`text` with every covered stretch replaced by the kind that starts it, in brackets."""
    parts, done = [], 0
    for start, order, end, kind in sorted((s, KINDS.index(k), e, k) for k, s, e in spans):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[] for _ in range(7)]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            spans = find_spans(text.as_py() or "")
            base = [s for s in spans if s[0] in BASE_KINDS]
            counts = [sum(s[0] == kind for s in base) for kind in BASE_KINDS]
            sha = hashlib.sha256(joined(base).encode()).hexdigest()
            for column, value in zip(columns, (doc_id, *counts, sha, joined(spans))):
                column.append(value)
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        )


def span_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, their digest, and all spans.

    Null and empty texts have no spans; a null id stays null; repeated rows stay repeated;
    other columns of `docs` are not read. Work is linear in a text's length, a partition is
    a stream of batches, and nothing is shuffled.
    """
    narrow = docs.selectExpr(f"cast(`{id_column}` as long) AS doc_id", f"`{text_column}` AS text")
    return narrow.mapInArrow(_digests, SPANS)


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`docs` with personal data in `text_column` replaced by its kind; null texts stay null.

    All columns are kept, in their order, and all rows, repeated ones and those with a null id
    too; an empty table gives no rows. Other columns may have any name.
    """
    place = docs.columns.index(text_column)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None else redacted(t, find_spans(t)) for t in (v.as_py() for v in batch.column(place))]
            arrays = [pa.array(texts, pa.string()) if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return docs.mapInArrow(rewrite, docs.schema)
