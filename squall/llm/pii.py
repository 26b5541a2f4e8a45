"""Personal data by anchor expansion.

One Aho-Corasick pass over each whole text finds anchors: at-signs, a dot or plus sign
before a digit, two digits with at most one space or hyphen between them, ``://`` and
cue words for accounts. From each anchor a local parser expands to the boundaries and
validates: nothing else of the text is looked at.

Base kinds, each the leftmost non-overlapping matches of its pattern, and dropped if
they fail its check: ``email``; ``ip`` (four parts of at most 255); ``card`` (13 to 19
digits that pass Luhn); ``phone`` (9 to 15 digits). The method adds

* ``iban``: two letters, two digits and 11 to 30 letters and digits, in groups or not,
  behind an IBAN cue, that pass the mod-97 check and end where a group does: at the
  length of the country, or else at the last group with which they pass;
* ``account``: 6 to 20 digits, with single spaces or hyphens, behind an account, routing,
  tax, passport or social-security cue and at most a few signs or a short word; of more
  digits the groups that fit; no amounts in groups of three, years or dates;
* ``userinfo``: ``user:password`` in front of the host of a URL.

Work is linear in the text: parsers start at the end of what their kind has read.

Defined results: a null text counts as empty; a row without spans has zero counts, the
SHA-256 of the empty string and empty ``spans``; repeated rows each get a result; a
null ``doc_id`` is carried; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from squall.llm.shards import map_rows

KINDS = ["email", "ip", "card", "phone", "iban", "account", "userinfo"]
BASE_KINDS = 4
SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
    "n_iban long, n_account long, n_userinfo long"
)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
USERINFO = re.compile(r"[A-Za-z0-9._~%+-]+:[^\s/@:?#]+(?=@[A-Za-z0-9.-]+)")
BEHIND_CUE = re.compile(r"(?:\s?(?:no|nr|number|num|id|code))?[\s.:#=]{0,4}", re.IGNORECASE)
#: two digits behind "no" make it the country of an IBAN
BEHIND_IBAN = re.compile(r"(?:\s?(?:no|nr|number|num|id|code)(?![0-9]{2}))?[\s.:#=]{0,4}", re.IGNORECASE)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20-]?[A-Z0-9]){11,30}")
ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,19}(?![0-9])")
#: amounts in groups of three digits, and lists of years and dates
AMOUNT = re.compile(r"[1-9][0-9]{0,2}(?:\x20[0-9]{3})+|(?:(?:19|20)[0-9]{2}(?:[\x20-]|$))+|(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9]")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
IBAN_LEAST = 15
#: lengths of the countries' IBANs
IBAN_SIZES = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

IBAN_CUES = ["iban"]
ACCOUNT_CUES = ["account", "acct", "a/c", "routing", "ssn", "social security", "passport", "tax id", "konto", "cuenta", "compte"]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    """The automaton: pattern -> (kind of anchor, its length)."""
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("://", ("userinfo", 3))
    for d in "0123456789":
        found.add_word(f".{d}", ("ip", 2))
        found.add_word(f"+{d}", ("phone", 2))
        for e in "0123456789":
            for between in ("", " ", "-"):
                found.add_word(d + between + e, ("card", 2 + len(between)))
    for kind, cues in (("iban", IBAN_CUES), ("account", ACCOUNT_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


class Parsers:
    """The local parsers of one text; ``read`` holds where each kind has read to."""

    def __init__(self, text: str):
        self.text, self.read, self.spans = text, dict.fromkeys(KINDS, 0), []

    def email(self, at: int, _: int) -> None:
        text, begin, least = self.text, at, self.read["email"]
        while begin > least and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (domain := DOMAIN.match(text, at + 1)):
            self._found("email", begin, domain.end())

    def ip(self, at: int, _: int) -> None:
        text, begin, least = self.text, at, self.read["ip"]
        if at < least:
            return
        while begin > least and text[begin - 1] in DIGITS:
            begin -= 1
        if begin == at:
            return
        chain = DOTTED.match(text, begin)
        parts = chain[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            stop = begin + sum(map(len, parts[k : k + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts[k : k + 4]):
                self._found("ip", begin, stop)
            begin = stop + 1
        self.read["ip"] = chain.end()

    def card(self, at: int, _: int) -> None:
        if at < self.read["card"]:
            return
        chain = CHAIN.match(self.text, at)
        self.read["card"] = chain.end()
        digits = chain[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            self._found("card", at, chain.end())

    def phone(self, at: int, _: int) -> None:
        if found := PHONE.match(self.text, at):
            if 9 <= sum(c in DIGITS for c in found[0]) <= 15:
                self._found("phone", at, found.end())

    def iban(self, at: int, size: int) -> None:
        text = self.text
        found = IBAN.match(text, BEHIND_IBAN.match(text, at + size).end())
        if not found:
            return
        read, ends = "", {}
        for stop, c in enumerate(found[0], found.start() + 1):
            if c in ALNUM:
                read += c
                if len(read) >= IBAN_LEAST and text[stop : stop + 1] not in ALNUM:
                    ends[read] = stop
        size = IBAN_SIZES.get(read[:2])
        for iban in sorted(ends, key=lambda e: (len(e) != size, -len(e))):
            if mod97(iban):
                return self._found("iban", found.start(), ends[iban])

    def account(self, at: int, size: int) -> None:
        found = ACCOUNT.match(self.text, BEHIND_CUE.match(self.text, at + size).end())
        if found and found.start() >= self.read["account"] and not AMOUNT.fullmatch(found[0]):
            self._found("account", found.start(), found.end())

    def userinfo(self, at: int, size: int) -> None:
        if found := USERINFO.match(self.text, at + size):
            self._found("userinfo", found.start(), found.end())

    def _found(self, kind: str, begin: int, stop: int) -> None:
        self.spans.append((KINDS.index(kind), begin, stop))
        self.read[kind] = stop


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """The spans of a text: (kind, start, end) in code points, by kind and start."""
    parsers = Parsers(text or "")
    parse = {k: getattr(parsers, k) for k in KINDS}
    for last, (kind, size) in anchors().iter(parsers.text):
        parse[kind](last - size + 1, size)
    return sorted(set(parsers.spans))


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{begin}:{stop}" for k, begin, stop in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: the columns of ``SCHEMA``."""

    def each():
        def row(doc_id: int | None, text: str | None) -> Iterator[tuple]:
            spans = scan(text)
            count = [0] * len(KINDS)
            for kind, _, _ in spans:
                count[kind] += 1
            base = shown([s for s in spans if s[0] < BASE_KINDS])
            digest = hashlib.sha256(base.encode()).hexdigest()
            yield doc_id, *count[:BASE_KINDS], digest, shown(spans), *count[BASE_KINDS:]

        return row

    return map_rows(docs.select("doc_id", "text"), SCHEMA, each)
