"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in a text: at-signs, ``://``, plus
signs, digits and cue words. From each anchor a small parser grows the span
to its boundaries and checks it. Spans are code points, end exclusive.

Base kinds (contract): ``email``, ``ip``, ``card``, ``phone``: per kind the
leftmost matches that don't overlap; a match that fails its check is dropped
and not tried again at another boundary.
Added kinds: ``login`` (user and password before the host of an address:
``scheme://user:password@host``) and ``account`` (an identifier after a cue
word such as "iban", "account", "Kontonummer", "compte" or "cuenta", in any case mix).
Cues and connectors are those of the table's languages (English, German, French,
Spanish). Between a cue and its identifier may stand signs and connector words such
as "number" or "ist", any number of them; the identifier may be written in groups
with single blanks, hyphens or dots between them. Identifiers with check digits or a
fixed form (IBAN, social security number, German tax number, French NIR, Spanish
DNI and NIE) are spans only if these hold, and end where they hold, at the longest
such place. Any other identifier is letters and digits with six digits at least; it goes on
over a blank as long as the groups are digits and it has 34 characters at most.

Defined cases: a null text counts as empty and has no spans. Repeated rows
each give a row; an empty table gives an empty result; extra columns are not
read, whatever their names. Time is linear in the text, whatever its length:
an anchor inside a span that was already read is skipped.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame

from forgeline.llm.shared import text_or_empty

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("login", "account")
#: words after which an identifier without check digits may stand
PLAIN_CUES = ("account", "acct", "passport",
              "konto", "kontonummer", "kundennummer", "reisepass", "reisepassnummer", "passnummer", "personalausweis", "ausweisnummer",
              "compte", "passeport", "cuenta", "pasaporte")
#: words that may stand between a cue and its identifier; no cue is among them, so no text is read for two cues
CONNECTORS = frozenset((
    "number", "num", "no", "nr", "is", "was", "id", "code", "the", "my", "your", "of", "for",
    "nummer", "ist", "lautet", "der", "die", "das", "mein", "meine", "meiner", "ihre", "ihrer",
    "n", "num\u00e9ro", "numero", "est", "le", "la", "mon", "votre", "bancaire", "de", "du",
    "n\u00famero", "es", "el", "mi", "su", "del", "bancaria", "corriente"))
#: code points of an identifier at most (an IBAN's limit)
LONGEST = 34

_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_LABEL = _ALNUM | {"-"}
_LOCAL = _ALNUM | set("._%+-")
_BETWEEN = frozenset(" \t\n\r:#=.,()'\"*_-\u00a0\u00b0\u00ba")
_GROUP_ENDS = frozenset(" -.")
_CONNECTOR_LENGTH = max(map(len, CONNECTORS))
_PHONE = _DIGITS | set(" ().-")
_USERINFO_END = frozenset("/?#@ \t\n\r\x0b\x0c\"'<>")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def iban_ok(code: str) -> bool:
    moved = (code[4:] + code[:4]).upper()
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ssn_ok(code: str) -> bool:
    """Nine digits, none of the parts out of use."""
    return len(code) == 9 and code.isdigit() and code[:3] not in ("000", "666") and code[0] != "9" and code[3:5] != "00" and code[5:] != "0000"


def tax_number_ok(code: str) -> bool:
    """Eleven digits, the last one a check digit modulo 11 and 10."""
    if len(code) != 11 or not code.isdigit() or code[0] == "0":
        return False
    product = 10
    for d in code[:10]:
        product = ((int(d) + product) % 10 or 10) * 2 % 11
    return (11 - product) % 10 == int(code[10])


def nir_ok(code: str) -> bool:
    """Fifteen digits (2A or 2B for the departments of Corsica), the last two a key modulo 97."""
    body, key = code[:13].upper(), code[13:]
    corsica = {"2A": "19", "2B": "18"}.get(body[5:7])
    body = body[:5] + corsica + body[7:] if corsica else body
    return len(code) == 15 and body.isdigit() and key.isdigit() and body[0] in "12" and 97 - int(body) % 97 == int(key)


#: fixed values: the check letters of Spanish identity numbers, by the number modulo 23
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"


def dni_ok(code: str) -> bool:
    """Eight digits, or X, Y or Z and seven digits, and a check letter."""
    code = code.upper()
    first = {"X": "0", "Y": "1", "Z": "2"}.get(code[:1], code[:1])
    number = first + code[1:8]
    return len(code) == 9 and number.isdigit() and code[8] == DNI_LETTERS[int(number) % 23]


#: cues of identifiers that are checked: least and greatest length, and the check
CHECKED_CUES = {
    "iban": (15, LONGEST, lambda code: code[:2].isalpha() and code[2:4].isdigit() and iban_ok(code)),
    **dict.fromkeys(("ssn", "social security"), (9, 9, ssn_ok)),
    **dict.fromkeys(("steuer-id", "steuernummer", "steueridentifikationsnummer"), (11, 11, tax_number_ok)),
    **dict.fromkeys(("nir", "s\u00e9curit\u00e9 sociale"), (15, 15, nir_ok)),
    **dict.fromkeys(("dni", "nie", "nif"), (9, 9, dni_ok)),
}
CUES = (*PLAIN_CUES, *CHECKED_CUES)

#: capitals of ASCII and Latin-1 to small letters, everything else, and so every place, as it is
_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: c + 32 for c in range(0xC0, 0xDF) if c != 0xD7}


def _run(text: str, at: int, allowed) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def grow_email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """From the at-sign, not before ``floor``."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    dots = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end = _run(text, end + 1, _LABEL)
        dots += 1
    return (start, end) if dots else None


def grow_ips(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """Addresses of the dotted digit groups that begin at a digit; where they end."""
    groups = []
    while True:
        end = _run(text, at, _DIGITS)
        groups.append((at, end))
        if end + 1 < len(text) and text[end] == "." and text[end + 1] in _DIGITS:
            at = end + 1
        else:
            break
    spans = []
    for i in range(0, len(groups) - 3, 4):
        four = groups[i:i + 4]
        if all(e - s < 400 and int(text[s:e]) <= 255 for s, e in four):
            spans.append((four[0][0], four[3][1]))
    return spans, end


def grow_card(text: str, at: int) -> tuple[tuple[int, int] | None, int]:
    """Digits with single blanks or hyphens between, from a digit; where they end."""
    end, n = at + 1, len(text)
    while end < n:
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    if end - at > 40:  # more than 19 digits
        return None, end
    digits = text[at:end].replace(" ", "").replace("-", "")
    return ((at, end) if 13 <= len(digits) <= 19 and luhn(digits) else None), end


def grow_phone(text: str, at: int) -> tuple[tuple[int, int] | None, int]:
    """From a plus sign; where the characters that were read end."""
    if at + 1 >= len(text) or text[at + 1] not in _DIGITS:
        return None, at + 1
    stop = _run(text, at + 2, _PHONE)
    end = stop
    while end > at + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < at + 4:  # the sign, a digit, something between, a digit
        return None, at + 1
    digits = sum(c in _DIGITS for c in text[at:end])
    return ((at, end) if 9 <= digits <= 15 else None), end


def grow_login(text: str, after: int) -> tuple[int, int] | None:
    """User and password between ``://`` (ends at ``after``) and an at-sign."""
    end, colon = after, False
    while end < len(text) and text[end] not in _USERINFO_END:
        colon |= text[end] == ":"
        end += 1
    return (after, end) if colon and end > after and end < len(text) and text[end] == "@" else None


def grow_account(text: str, cue_start: int, after: int) -> tuple[int, int] | None:
    """The identifier after a cue word."""
    if (cue_start and text[cue_start - 1].isalnum()) or (after < len(text) and text[after].isalnum()):
        return None
    at = after
    while True:
        at = _run(text, at, _BETWEEN)
        end = at
        while end < len(text) and text[end].isalpha():
            end += 1
        if end == at or end - at > _CONNECTOR_LENGTH or text[at:end].lower() not in CONNECTORS or (end < len(text) and (text[end].isalnum() or text[end] == "-")):
            break
        at = end
    checked = CHECKED_CUES.get(text[cue_start:after].translate(_LOWER))
    if checked:
        return _checked(text, at, *checked)
    end, digits = _group(text, at)
    n = end - at
    while digits and end + 1 < len(text) and text[end] == " ":  # groups of digits, a blank between
        stop, more = _group(text, end + 1)
        if not more or more != sum(c != "-" for c in text[end + 1:stop]) or (stop < len(text) and text[stop].isalnum()) or n + stop - end - 1 > LONGEST:
            break
        n, digits, end = n + stop - end - 1, digits + more, stop
    return (at, end) if digits >= 6 else None


def _group(text: str, at: int) -> tuple[int, int]:
    """Where the letters and digits (single hyphens between) from ``at`` end; their digits."""
    end = at
    while end < len(text) and (text[end] in _ALNUM or end > at and text[end] == "-" and end + 1 < len(text) and text[end + 1] in _ALNUM):
        end += 1
    return end, sum(c in _DIGITS for c in text[at:end])


def _checked(text: str, at: int, least: int, most: int, holds) -> tuple[int, int] | None:
    """The longest run of groups from ``at`` that passes its check."""
    code, end, best = "", at, None
    while True:
        stop = _run(text, end, _ALNUM)
        if stop == end or len(code) + stop - end > most:
            return best
        code += text[end:stop]
        if len(code) >= least and (stop == len(text) or not text[stop].isalnum()) and holds(code):
            best = at, stop
        if stop + 1 >= len(text) or text[stop] not in _GROUP_ENDS:
            return best
        end = stop + 1


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for anchor in ("@", "://", "+", *_DIGITS):
        a.add_word(anchor, anchor)
    for cue in CUES:
        a.add_word(cue, cue)
    a.make_automaton()
    return a


def find_spans(text: str, anchors) -> list[tuple[str, int, int]]:
    """All spans, by kind as in ``KINDS``, then start."""
    found = {k: [] for k in KINDS}
    floor = dict.fromkeys(KINDS, 0)  # per kind, up to where the text was read
    for last, word in anchors.iter(text.translate(_LOWER)):
        at = last - len(word) + 1
        if word in _DIGITS:
            if at >= floor["ip"]:
                spans, floor["ip"] = grow_ips(text, at)
                found["ip"] += spans
            if at >= floor["card"]:
                span, floor["card"] = grow_card(text, at)
                if span:
                    found["card"].append(span)
        elif word == "@":
            span = grow_email(text, at, floor["email"])
            if span:
                found["email"].append(span)
                floor["email"] = span[1]
        elif word == "+":
            if at >= floor["phone"]:
                span, floor["phone"] = grow_phone(text, at)
                if span:
                    found["phone"].append(span)
        elif word == "://":
            span = grow_login(text, last + 1)
            if span and span[0] >= floor["login"]:
                found["login"].append(span)
                floor["login"] = span[1]
        else:
            span = grow_account(text, at, last + 1)
            if span and span[0] >= floor["account"]:
                found["account"].append(span)
                floor["account"] = span[1]
    return [(k, s, e) for k in KINDS for s, e in found[k]]


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    def run(batches):
        import pyarrow as pa

        anchors = automaton()
        for b in batches:
            counts, digests, all_spans = [], [], []
            for value in b.column(1):
                spans = find_spans(value.as_py(), anchors)
                base = [s for s in spans if s[0] in BASE_KINDS]
                counts.append([sum(s[0] == k for s in base) for k in BASE_KINDS])
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                all_spans.append(written(spans))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(BASE_KINDS))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *columns, pa.array(digests, pa.string()), pa.array(all_spans, pa.string())],
                ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, {counts}, base_sha256 string, spans string")
