"""Personal data replaced by pseudonyms of the same format, from a keyed Feistel permutation."""

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Key of the queries here; users pass their own, without which pseudonyms cannot be turned back.
KEY = b"a key of the tests"
ROUNDS = 8


class Permutation:
    """A keyed permutation of the numbers below any size: a Feistel network on two digits, walked until it is inside."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, kind: str, size: int, i: int, half: int) -> int:
        text = f"{kind}|{size}|{i}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key[:64], digest_size=32).digest(), "big")

    @staticmethod
    def _halves(size: int) -> tuple[int, int]:
        a = 1 << ((size - 1).bit_length() + 1) // 2
        return a, -(-size // a)

    def forward(self, value: int, size: int, kind: str) -> int:
        """Where `value` goes among the numbers below `size`; each kind of value has a permutation of its own."""
        if size < 2:
            return value
        a, b = self._halves(size)
        while True:
            left, right = value % a, value // a
            for i in range(0, ROUNDS, 2):
                left = (left + self._round(kind, size, i, right)) % a
                right = (right + self._round(kind, size, i + 1, left)) % b
            value = right * a + left
            if value < size:
                return value

    def back(self, value: int, size: int, kind: str) -> int:
        """The value that goes to `value`."""
        if size < 2:
            return value
        a, b = self._halves(size)
        while True:
            left, right = value % a, value // a
            for i in reversed(range(0, ROUNDS, 2)):
                right = (right - self._round(kind, size, i + 1, left)) % b
                left = (left - self._round(kind, size, i, right)) % a
            value = right * a + left
            if value < size:
                return value


Move = Callable[[int, int, str], int]


def _alphabet(c: str) -> str:
    for letters in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        if c in letters:
            return letters
    return ""


def _signs(text: str, kind: str, move: Move) -> str:
    """Digits, small and capital letters permuted together, each staying of its sort; other signs stay."""
    value, size = 0, 1
    for c in text:
        if letters := _alphabet(c):
            value, size = value * len(letters) + letters.index(c), size * len(letters)
    value, out = move(value, size, kind), []
    for c in reversed(text):
        if letters := _alphabet(c):
            value, at = divmod(value, len(letters))
            c = letters[at]
        out.append(c)
    return "".join(reversed(out))


def _refill(text: str, digits: str) -> str:
    """`text` with other digits or letters in the places of its own."""
    new = iter(digits)
    return "".join(next(new) if c.isalnum() else c for c in text)


def _check_digit(digits: str) -> str:
    """The Luhn digit that goes behind `digits`."""
    total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return str(-total % 10)


def _email(text: str, move: Move) -> str | None:
    name, domain = text.rsplit("@", 1)
    labels = domain.lower().rsplit(".", 1)
    if name.startswith(".") or name.endswith(".") or ".." in text:
        return None
    # Addresses are compared in lower case, so one address in two spellings stays one.
    return _signs(name.lower(), "name", move) + "@" + _signs(labels[0], "domain", move) + "." + labels[1]


def _is_card(text: str) -> bool:
    digits = "".join(c for c in text if c.isdigit())
    return 13 <= len(digits) <= 19 and _check_digit(digits[:-1]) == digits[-1] and len(set(digits)) > 1


def _card(text: str, move: Move) -> str | None:
    if not _is_card(text):
        return None
    digits = "".join(c for c in text if c.isdigit())
    # The digits that name the network, and so the length, stay.
    keep, _ = _network(digits)
    own = digits[:keep] + _signs(digits[keep:-1], f"card {digits[:keep]}", move)
    return _refill(text, own + _check_digit(own))


def _number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text))


def _is_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and _number(plain[4:] + plain[:4]) % 97 == 1


def _iban(text: str, move: Move) -> str | None:
    if not _is_iban(text):
        return None
    plain = text.replace(" ", "")
    account = _signs(plain[4:], f"iban {plain[:2]}", move)
    check = 98 - _number(account + plain[:2] + "00") % 97
    return _refill(text, plain[:2] + f"{check:02d}" + account)


def _ssn(text: str, move: Move) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = [x for x in range(1, 900) if x != 666]
    value = move((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, "ssn")
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _address(text: str, move: Move) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if any(x > 255 for x in parts) or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    value = move(int.from_bytes(bytes(parts), "big"), 1 << 32, "address")
    return ".".join(str(x) for x in value.to_bytes(4, "big"))


#: Country codes of two digits; 1 and 7 stand alone, and all others have three.
_TWO_DIGITS = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)


def _phone(text: str, move: Move) -> str | None:
    digits = "".join(c for c in text if c.isdigit())
    if not 8 <= len(digits) <= 15:
        return None
    keep = 0 if text[0] != "+" else 1 if digits[0] in "17" else 2 if digits[:2] in _TWO_DIGITS else 3
    return _refill(text, digits[:keep] + _signs(digits[keep:], f"phone {digits[:keep]}", move))


_DAYS = (datetime.date(1900, 1, 1), datetime.date(2099, 12, 31))


def _date(text: str, move: Move) -> str | None:
    sign = next(c for c in text if not c.isdigit())
    parts = text.split(sign)
    numbers = [int(x) for x in parts]
    if len(parts[0]) == 4:
        order = (0, 1, 2)  # year, month, day
    else:
        order = (2, 0, 1) if numbers[1] > 12 and numbers[0] <= 12 else (2, 1, 0)
    try:
        day = datetime.date(*(numbers[i] for i in order))
    except ValueError:
        return None
    first, last = _DAYS
    if not first <= day <= last:
        return None
    day = first + datetime.timedelta(move((day - first).days, (last - first).days + 1, "date"))
    own = dict(zip(order, (day.year, day.month, day.day)))
    return sign.join(f"{own[i]:0{len(p) if len(p) > 1 else 1}d}" for i, p in enumerate(parts))


def _secret(text: str, move: Move) -> str | None:
    return text[:4] + _signs(text[4:], "key", move) if text.startswith(("AKIA", "ASIA")) else _signs(text, "token", move)


#: What is looked for in this order, and who checks and replaces it.
KINDS: dict[str, tuple[str, Callable[[str, Move], str | None]]] = {
    "email": (r"(?<![\w.+-])[A-Za-z0-9][\w.+%-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])", _email),
    "key": (r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])", _secret),
    "token": (r"(?i:(?<=token = \")|(?<=secret = \")|(?<=key = \")|(?<=password = \")|(?<=token=\")|(?<=secret=\")|(?<=key=\"))[A-Za-z0-9_-]{16,}", _secret),
    "iban": (r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", _iban),
    "address": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", _address),
    "date": (r"(?<![\w/.-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\w/-]|\.\d)", _date),
    "ssn": (r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    "card": (r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)", _card),
    "phone": (r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w|[.-]\d)", _phone),
}
_PATTERNS = [(k, re.compile(p), f) for k, (p, f) in KINDS.items()]


#: Kinds whose pattern may reach into what stands beside a value, and how a value is checked.
_CHECKED = {"card": _is_card, "iban": _is_iban}
#: Signs of a country's IBAN.
_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AT20 BE16 BG22 CH21 CY28 CZ24 DE22 DK18 EE20 ES24 FI18 FR27 GB22 GR27 HR21 HU28 IE22 IT27 LI21 LT20 LU20 LV21 MT31 NL18 NO15 "
    "PL28 PT25 RO24 SE24 SI19 SK24").split()}  # fmt: skip


#: First digits of the networks (from, to) and the digits of their cards.
_NETWORKS = (("4", "4", 16), ("51", "55", 16), ("2221", "2720", 16), ("34", "34", 15), ("37", "37", 15), ("35", "35", 16), ("60", "65", 16),
             ("30", "30", 14), ("36", "36", 14), ("38", "39", 14))


_GOES_ON = re.compile(r"\w|[.-]\d")


def _network(digits: str) -> tuple[int, int]:
    """How many first digits name the network, and how many digits its cards have; 1 and 0 for others."""
    for low, high, n in _NETWORKS:
        if low <= digits[: len(low)] <= high:
            return len(low), n
    return 1, 0


def _candidates(kind: str, m: re.Match, text: str) -> Iterator[tuple[int, int]]:
    """Spans inside a match, best first. A match may take in groups that follow the value, or begin with groups before it.

    First cards of their network's length from the start of a group to the end of one, and IBANs of their country's length, so
    what stands beside them makes no difference; then, for other networks and countries, the longest run of groups.
    """
    a, end = m.span()
    if kind == "iban":
        ends = [end, *(i for i in range(end - 1, a, -1) if not text[i].isalnum())]
        ends.sort(key=lambda z: len(text[a:z].replace(" ", "")) != _LENGTHS.get(text[a : a + 2]))
        yield from ((a, z) for z in ends)
        return
    # The groups go on behind the match, which is bounded: a card may begin in it and end there.
    places, i = [], a
    while i < len(text) and len(places) < 38 and (text[i].isdigit() or text[i] in " -" and text[i + 1 : i + 2].isdigit()):
        places += [i] if text[i].isdigit() else []
        i += 1
    starts = [k for k, i in enumerate(places) if i < end and (k == 0 or text[i - 1] == " ")]
    stops = [i + 1 for i in places if not text[i + 1 : i + 2].isdigit()]
    for k in starts:
        _, n = _network("".join(text[i] for i in places[k : k + 4]))
        if n and k + n <= len(places):
            z = places[k + n - 1] + 1
            if z in stops and not _GOES_ON.match(text, z):
                yield places[k], z
    for k in starts:
        yield from ((places[k], z) for z in reversed(stops) if places[k] < z <= end)


def _checked(kind: str, pattern: re.Pattern, text: str, taken: bytearray) -> Iterator[tuple[int, int]]:
    """The spans that pass the check and are not taken, from left to right."""
    at = 0
    while m := pattern.search(text, at):
        at = m.start() + 1
        for a, z in _candidates(kind, m, text):
            if 1 not in taken[a:z] and _CHECKED[kind](text[a:z]):
                yield a, z
                at = z
                break


def _apply(text: str, move: Move) -> tuple[str, dict[str, int], list[tuple[int, int]]]:
    found: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))
    digits = re.search(r"\d", text) is not None
    for kind, pattern, replace in _PATTERNS:
        if kind == "email" and "@" not in text or kind not in ("email", "token") and not digits:
            continue
        spans = _checked(kind, pattern, text, taken) if kind in _CHECKED else (m.span() for m in pattern.finditer(text))
        for a, z in spans:
            new = None if 1 in taken[a:z] else replace(text[a:z], move)
            if new is not None:
                found.append((a, z, kind, new))
                taken[a:z] = b"\1" * (z - a)
    out, at, counts = [], 0, {}
    for a, z, kind, new in sorted(found):
        out += [text[at:a], new]
        at = z
        counts[kind] = counts.get(kind, 0) + 1
    return "".join(out) + text[at:], counts, sorted((a, z) for a, z, _, _ in found)


def pseudonymise(text: str, key: bytes = KEY) -> tuple[str, dict[str, int], list[tuple[int, int]]]:
    """A text with pseudonyms, how many of each kind, and the spans of the values in the given text."""
    return _apply(text, Permutation(key).forward)


def restore(text: str, key: bytes = KEY) -> str:
    """The text before: pseudonyms have the format of what they replace, so they are found and turned back."""
    return _apply(text, Permutation(key).back)[0]


def replace_personal_data(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """The columns of `docs` with pseudonyms in `text`, plus replaced (how many) and kinds (how many of each kind).

    E-mail addresses, payment cards with a right check digit, IBANs with right check digits, social security numbers in the
    valid ranges, IPv4 addresses, telephone numbers, dates between 1900 and 2099, and access keys are permuted among all
    values of their format by a key. The same value has the same pseudonym in every document, however it is grouped;
    check digits and calendar days stay valid. Numbers that fail the check stay as they are, and so does all other text.
    Cards and IBANs beside other groups of digits or capitals are found at the group borders, by the length that their network or
    country has, and have the same pseudonym as alone; those groups stay. `restore` turns pseudonyms back, but for capitals in
    addresses, dates written month first whose new day is below 13, and some numbers of no known network beside other groups.

    A null text stays null with nothing replaced. Columns of the input called replaced or kinds are replaced. Empty tables
    give an empty result, and rows stay as they are otherwise.
    """
    rows = docs.drop("replaced", "kinds")

    @F.pandas_udf("text string, replaced long, kinds map<string,long>")
    def hide(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        move = _Remembered(key).forward
        for batch in texts:
            found = [(None, {}) if t is None else _apply(t, move)[:2] for t in batch]
            yield pd.DataFrame({"text": [t for t, _ in found], "replaced": [sum(k.values()) for _, k in found], "kinds": [k for _, k in found]})

    others = [c for c in rows.columns if c != "text"]
    return rows.withColumn("_hidden", hide("text")).select(*others, "_hidden.text", "_hidden.replaced", "_hidden.kinds")


class _Remembered(Permutation):
    """Rounds of values met often are computed once; at most 100,000 are held."""

    def __init__(self, key: bytes):
        super().__init__(key)
        self.held: dict[tuple[int, int, str], int] = {}

    def forward(self, value: int, size: int, kind: str) -> int:
        at = (value, size, kind)
        if at not in self.held:
            if len(self.held) >= 100_000:
                self.held.clear()
            self.held[at] = super().forward(value, size, kind)
        return self.held[at]
