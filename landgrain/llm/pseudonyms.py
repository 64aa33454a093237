"""Format-preserving pseudonyms for personal data.

Numbers and dates that pass their validity rule are replaced by a keyed permutation
within their format, a Feistel network over mixed radices.  Equal values become equal
pseudonyms in every document, and pseudonyms pass the same validity rule.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.words import parts

ROUNDS = 8
KEY = b"landgrain"
"""A key for tests and checks; a user passes one of their own."""


def permute(digits: list[int], radices: list[int], key: bytes, tweak: str) -> list[int]:
    """A keyed bijection on numerals of given radices: alternating Feistel rounds on two halves."""
    half = len(digits) // 2
    sizes = []
    for part in (radices[:half], radices[half:]):
        n = 1
        for r in part:
            n *= r
        sizes.append(n)

    def number(ds: list[int], rs: list[int]) -> int:
        n = 0
        for d, r in zip(ds, rs):
            n = n * r + d
        return n

    def numeral(n: int, rs: list[int]) -> list[int]:
        out = []
        for r in reversed(rs):
            n, d = divmod(n, r)
            out.append(d)
        return out[::-1]

    sides = [number(digits[:half], radices[:half]), number(digits[half:], radices[half:])]
    head = f"{tweak}|{'.'.join(map(str, radices))}|".encode()
    for round_no in range(ROUNDS):
        here = round_no % 2
        text = head + f"{round_no}|{sides[1 - here]}".encode()
        f = int.from_bytes(hashlib.blake2b(text, key=key, digest_size=32).digest(), "big")
        sides[here] = (sides[here] + f) % sizes[here]
    return numeral(sides[0], radices[:half]) + numeral(sides[1], radices[half:])


def _cycle(digits: list[int], radices: list[int], key: bytes, tweak: str, valid) -> list[int]:
    """Permute until the result is valid again; from a valid start this is a bijection on valid values."""
    out = permute(digits, radices, key, tweak)
    while not valid(out):
        out = permute(out, radices, key, tweak)
    return out


def _refill(shape: str, digits: list[int]) -> str:
    """Put digits in place of those in `shape`."""
    it = iter(digits)
    return "".join(str(next(it)) if "0" <= c <= "9" else c for c in shape)


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    """Whether the check digit of a payment card number is right."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = d * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def card(text: str, key: bytes) -> str | None:
    """Payment cards of 13 to 19 digits with a right check digit keep it right.

    A bare run of 16 digits with a card's first digit (3 to 6) is pseudonymised too when
    the check digit is wrong: as a plain number, without a check digit.
    """
    ds = _digits(text)
    if not 13 <= len(ds) <= 19:
        return None
    if luhn(ds):
        body = permute(ds[:-1], [10] * (len(ds) - 1), key, "card")
        last = next(c for c in range(10) if luhn([*body, c]))
        return _refill(text, [*body, last])
    if len(ds) == 16 and 3 <= ds[0] <= 6:
        out = _cycle(ds, [10] * 16, key, "number", lambda x: 3 <= x[0] <= 6 and not luhn(x))
        return _refill(text, out)
    return None


def address(text: str, key: bytes) -> str | None:
    """IPv4 addresses: four numbers of 0 to 255."""
    octets = text.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    return ".".join(map(str, permute([int(o) for o in octets], [256] * 4, key, "ip")))


def phone(text: str, key: bytes) -> str | None:
    """Ten-digit numbers whose area code starts with 2 to 9; a country code 1 is kept."""
    shape, head = text, ""
    if m := re.match(r"\+?1[ .-]?", text):
        head, shape = m[0], text[m.end() :]
    ds = _digits(shape)
    if len(ds) != 10 or ds[0] < 2:
        return None
    return head + _refill(shape, _cycle(ds, [10] * 10, key, "phone", lambda x: x[0] >= 2))


# Digits after the country code, for countries whose numbers all have one of few lengths.
NATIONAL = {
    "1": (10,), "7": (10,), "27": (9,), "30": (10,), "31": (9,), "32": (8, 9), "33": (9,), "34": (9,), "36": (8, 9),
    "40": (9,), "41": (9,), "44": (9, 10), "45": (8,), "47": (8,), "48": (9,), "51": (8, 9), "52": (10,), "61": (9,),
    "63": (10,), "65": (8,), "66": (8, 9), "81": (9, 10), "82": (8, 9, 10), "84": (9, 10), "90": (10,), "91": (10,), "92": (9, 10),
    "351": (9,), "353": (7, 8, 9), "380": (9,), "420": (9,), "421": (9,), "852": (8,), "886": (8, 9), "966": (8, 9), "971": (8, 9), "972": (8, 9),
}


def _country(ds: list[int]) -> str:
    """The country code of NATIONAL that the digits start with, or nothing."""
    head = "".join(map(str, ds[:3]))
    return next((head[:k] for k in (1, 2, 3) if head[:k] in NATIONAL), "")


def international(text: str, key: bytes) -> str | None:
    """Numbers with a plus sign and 8 to 15 digits keep their first two digits, and a country code of NATIONAL."""
    ds = _digits(text)
    if not 8 <= len(ds) <= 15:
        return None
    k = max(2, len(_country(ds)))
    return _refill(text, ds[:k] + permute(ds[k:], [10] * (len(ds) - k), key, "plus" + "".join(map(str, ds[:k]))))


def _real_ssn(ds: list[int]) -> bool:
    area, group, serial = ds[0] * 100 + ds[1] * 10 + ds[2], ds[3] * 10 + ds[4], sum(ds[5:])
    return area not in (0, 666) and area < 900 and group > 0 and serial > 0


def social(text: str, key: bytes) -> str | None:
    """Social security numbers with a valid area, group and serial."""
    ds = _digits(text)
    if not _real_ssn(ds):
        return None
    return _refill(text, _cycle(ds, [10] * 9, key, "ssn", _real_ssn))


def _mod97(country: str, check: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + check)) % 97


def iban(text: str, key: bytes) -> str | None:
    """International account numbers with a right checksum; country, letters and spacing are kept."""
    bare = text.replace(" ", "").upper()
    country, check, body = bare[:2], bare[2:4], bare[4:]
    if not 15 <= len(bare) <= 34 or _mod97(country, check, body) != 1:
        return None
    ds = _digits(body)
    new = _refill(body, permute(ds, [10] * len(ds), key, f"iban{country}"))
    check_now = 98 - _mod97(country, "00", new)
    return _refill(text, [*divmod(check_now, 10), *_digits(new)])


_FIRST, _LAST = dt.date(1900, 1, 1), dt.date(2099, 12, 31)


def date(text: str, key: bytes) -> str | None:
    """Calendar dates of 1900 to 2099 as year-month-day or day/month/year, in the same layout."""
    a, b, c = (int(x) for x in re.split(r"[-/.]", text))
    year_first = text[4:5] in ("-", "/", ".")
    y, m, d = (a, b, c) if year_first else (c, b, a)
    swapped = False
    if not year_first and m > 12 >= d:
        d, m, swapped = m, d, True
    try:
        day = (dt.date(y, m, d) - _FIRST).days
    except ValueError:
        return None
    days = (_LAST - _FIRST).days + 1
    if not 0 <= day < days:
        return None
    # The layout is part of the format: a swapped date must stay one, so days are walked until it reads the same.
    keep = lambda t: (t.day > 12) == swapped if not year_first and swapped else True
    radices = [272, 269]  # 272 * 269 >= the days of 200 years
    now = list(divmod(day, 269))
    now = _cycle(now, radices, key, "date" + "s" * swapped, lambda x: x[0] * 269 + x[1] < days and keep(_FIRST + dt.timedelta(x[0] * 269 + x[1])))
    t = _FIRST + dt.timedelta(now[0] * 269 + now[1])
    s1, s2 = re.findall(r"[-/.]", text)
    if year_first:
        return f"{t.year:04d}{s1}{t.month:02d}{s2}{t.day:02d}"
    x, z = (t.month, t.day) if swapped else (t.day, t.month)
    return f"{x:02d}{s1}{z:02d}{s2}{t.year:04d}"


_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def email(text: str, key: bytes) -> str | None:
    """Mail addresses: letters and digits of the local part stay in their class; the domain is kept."""
    local, domain = text.rsplit("@", 1)
    digits, radices, sets = [], [], []
    for c in local:
        for alphabet in (_LOWER, _UPPER, "0123456789"):
            if c in alphabet:
                digits.append(alphabet.index(c))
                radices.append(len(alphabet))
                sets.append(alphabet)
    if not digits:
        return None
    new = permute(digits, radices, key, "mail")
    it = iter(zip(sets, new))
    out = []
    for c in local:
        if c in _LOWER or c in _UPPER or c in "0123456789":
            alphabet, d = next(it)
            out.append(alphabet[d])
        else:
            out.append(c)
    return "".join(out) + "@" + domain


# Tried in this order at each place; the first pattern whose value is valid counts.
KINDS = {
    "email": (r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+", email),
    "iban": (r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])", iban),
    "ip": (r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])", address),
    "date": (r"(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2[0-9]{4})(?![0-9]|[-/.][0-9])", date),
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])", social),
    "card": (r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9]|-[0-9])", card),
    "phone": (r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|-[0-9])", phone),
    "plus": (r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,5}\)?){2,6}(?![0-9]|-[0-9])", international),
}
_STARTS = re.compile(r"(?<![A-Za-z0-9@._%+-])[._%+-]*([A-Za-z0-9])[A-Za-z0-9._%+-]*@|(?<![A-Za-z0-9])(?:[0-9]|[A-Z]{2}[0-9]{2})|\+[0-9]|\([0-9]")
_PATTERNS: dict[str, re.Pattern] = {k: re.compile(p) for k, (p, _) in KINDS.items()}


# Characters of an account number, by country.
IBAN_SIZES = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31,
    "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
# Lengths of payment cards by their first digit.
CARD_SIZES = {2: (16,), 3: (14, 15, 16), 4: (13, 16, 19), 5: (16,), 6: (16, 17, 18, 19)}
_CARD_RUN = re.compile(r"[0-9](?:[ -]?[0-9]){12,18}")
_PLUS_RUN = re.compile(r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,5}\)?){1,8}")


def _group_ends(text: str, begin: int, end: int) -> list[int]:
    """The ends of the groups of digits in a match, the last first."""
    return [e for e in range(end, begin, -1) if "0" <= text[e - 1] <= "9" and not "0" <= text[e : e + 1] <= "9"]


def _usual_card(text: str, begin: int) -> int | None:
    """The end of the longest card at `begin` that has a right check digit and a usual length."""
    if run := _CARD_RUN.match(text, begin):
        for end in _group_ends(text, begin, run.end()):
            ds = _digits(text[begin:end])
            if len(ds) in CARD_SIZES.get(ds[0], ()) and luhn(ds):
                return end
    return None


def _tries(kind: str, text: str, begin: int) -> Iterator[int]:
    """The ends of the values of one kind that may start at `begin`, the best first.

    More groups may follow a number, such as a card's CVV or an amount.  The longest match
    is tried first, then ends at its groups; numbers whose country has a fixed length end there.
    """
    found = _PATTERNS[kind].match(text, begin)
    if kind == "iban" and found:
        ends = [found.end(), *(e for e in range(found.end() - 1, begin, -1) if text[e] == " ")]
        size = IBAN_SIZES.get(found[0][:2])
        yield from sorted(ends, key=lambda e: e - begin - text.count(" ", begin, e) != size)
        return
    if kind == "plus" and (run := _PLUS_RUN.match(text, begin)):
        ds = _digits(run[0])
        code = _country(ds)
        ends = {len(_digits(text[begin:e])) - len(code): e for e in _group_ends(text, begin, run.end())}
        yield from (e for k, e in ends.items() if k in NATIONAL.get(code, ()))
    if found:
        yield found.end()
    if kind == "card" and (run := _CARD_RUN.match(text, begin)):
        ends = _group_ends(text, begin, run.end())
        usual = _usual_card(text, begin)
        # A number that stands before a card must not take a part of it.
        if usual and not any("0" <= text[k] <= "9" and not text[k - 1].isdigit() and (_usual_card(text, k) or 0) > usual for k in range(begin + 1, usual)):
            yield usual
        yield from (e for e in ends if e - begin == 16 and text[begin:e].isdigit())


def pseudonymise(text: str, key: bytes = KEY, known: dict | None = None) -> tuple[str, int]:
    """The text with its personal data replaced, and how many values were."""
    known = {} if known is None else known
    out, at, n = [], 0, 0
    while m := _STARTS.search(text, at):
        done = None
        # Marks before a mail name are no part of it; whatever else starts at them is tried next.
        for begin, (kind, (_, fn)) in product(dict.fromkeys((m.start(1), m.start()) if m[1] else (m.start(),)), KINDS.items()):
            for end in _tries(kind, text, begin):
                value = text[begin:end]
                if (kind, value) not in known:
                    if len(known) > 200_000:
                        known.clear()
                    known[kind, value] = fn(value, key)
                new = known[kind, value]
                if new is not None:
                    done = (begin, end, new)
                    break
            if done:
                break
        if done:
            out += [text[at : done[0]], done[2]]
            at, n = done[1], n + 1
        else:
            begin = m.start()
            stop = begin + 1
            while text[begin].isalnum() and stop < len(text) and text[stop].isascii() and text[stop].isalnum():
                stop += 1
            out.append(text[at:stop])
            at = stop
    out.append(text[at:])
    return "".join(out), n


def replace_private(docs: DataFrame, text: str = "text", key: bytes = KEY, count: str | None = "n_private") -> DataFrame:
    """Replace the text column by its pseudonymised form and add the number of values replaced.

    Whole texts are searched.  Null texts stay null with 0 values; empty tables, repeated
    rows and other columns pass through, and a column named like `count` is replaced.
    """
    kept = [c for c in docs.columns if c != count]
    schema = docs.select(*kept)
    schema = (schema.withColumn(count, F.lit(0).cast("long")) if count else schema).schema

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        k = kept.index(text)
        for batch in batches:
            for a, b in parts(batch.column(k)):
                rows = batch.slice(a, b - a)
                column = rows.column(k)
                hit = pc.fill_null(pc.match_substring_regex(column, r"[0-9]|@"), False).to_pylist()
                texts, counts = column.to_pylist(), [0] * len(column)
                for i, yes in enumerate(hit):
                    if yes:
                        texts[i], counts[i] = pseudonymise(texts[i], key, known)
                columns = [*rows.columns]
                columns[k] = pa.array(texts, column.type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())][: len(kept) + bool(count)], [*kept, count][: len(kept) + bool(count)])

    return docs.select(*kept).mapInArrow(replace, schema)


@query("op6_feistel_pseudonyms")
def op6(spark, sf):
    return replace_private(table(spark, sf, "documents").select("doc_id", "text"))


def with_pseudonyms(docs: DataFrame) -> DataFrame:
    """Documents with pseudonyms in their texts and n_chars to match."""
    done = replace_private(docs)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("n_private") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)
