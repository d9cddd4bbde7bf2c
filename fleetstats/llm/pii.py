"""Personal data found by growing anchors.

One Aho-Corasick automaton finds the anchors of a text: at-signs, plus signs, the digits, address schemes and
identifier cues. Small parsers grow each anchor into the span it stands in and check its bounds. Four base kinds follow
fixed grammars; the scheme and cue anchors add addresses and accounts, which take nothing away from the base spans.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetstats.llm.common import add_columns

# The kinds in their order, and the grammars around the anchors.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("account", "api key", "api-key", "api_key", "apikey", "iban", "passport", "password", "secret", "ssn", "token")
SECRETS = ("api key", "api-key", "api_key", "apikey", "password", "secret", "token")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ADDRESS = re.compile(r"[A-Za-z0-9._~%+-]+(?:@[A-Za-z0-9.-]+)?(?::[0-9]+)?(?:[/?#][^\s<>\"'{}|\\^`]*)?")
WORDS = r"(?:[\x20\t_-]*(?:number|num|no|nr|id|key|code|value|is|was)(?![A-Za-z0-9])\.?)"
GAP = rf"[\"']?(?:{WORDS}*[\x20\t]*[\"']?[\x20\t]*[:=#]{WORDS}*[\x20\t]*[:=#]?|{WORDS}+)[\x20\t]*[\"']?"
VALUE = re.compile(GAP + r"([A-Za-z0-9][A-Za-z0-9_-]{5,})", re.IGNORECASE | re.ASCII)
# what stands directly behind a separator up to a blank, quote, comma, semicolon or bracket, end punctuation apart
SECRET = re.compile(
    rf"[\"']?{WORDS}*[\x20\t]*[:=]{WORDS}*[\x20\t]*(?:\"([^\"\r\n]+)\"|'([^'\r\n]+)'|([^\s\"',;<>()\[\]{{}}:=][^\s\"',;<>()\[\]{{}}]*))",
    re.IGNORECASE | re.ASCII)
IBAN = re.compile(
    rf"(?:(?i:{GAP})|[\x20\t]+)([A-Z]{{2}}[0-9]{{2}}(?:[\x20-]?[A-Z0-9]){{11,30}}|[A-Za-z]{{2}}[0-9]{{2}}(?:[\x20-]?[A-Za-z0-9]){{11,30}})", re.ASCII)

AT, PLUS, DIGIT, SCHEME, CUE = range(5)


@functools.cache
def automaton() -> ahocorasick.Automaton:
    """Anchors as they stand in lower-case text, with what they announce and their length."""
    found = ahocorasick.Automaton()
    for anchor, kind in [("@", AT), ("+", PLUS), *((d, DIGIT) for d in "0123456789"),
                         *((s, SCHEME) for s in SCHEMES), *((c, CUE) for c in CUES)]:
        found.add_word(anchor, (kind, len(anchor)))
    found.make_automaton()
    return found


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(number: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(number)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around an at-sign; its local part begins at `floor` at the earliest."""
    start = at
    while start > floor and text[start - 1] in LOCAL_CHARS:
        start -= 1
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def valid_ip(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.split("."))


def valid_card(match: str) -> bool:
    number = digits_of(match)
    return 16 <= len(number) <= 19 and luhn(number)


def valid_phone(match: str) -> bool:
    return 8 <= len(digits_of(match)) <= 15


def valid_iban(match: str) -> bool:
    number = re.sub(r"[\x20-]", "", match).upper()
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def iban(text: str, at: int) -> tuple[int, int] | None:
    """The longest valid number of an account behind a cue, its groups apart or not."""
    if found := IBAN.match(text, at):
        start, end = found.span(1)
        for stop in range(end, start + 14, -1):
            if text[stop - 1].isalnum() and not text[stop:stop + 1].isalnum() and valid_iban(text[start:stop]):
                return start, stop
    return None


def account(text: str, at: int, cue: str) -> tuple[int, int] | None:
    """The value behind a cue; words may stand between them.

    A value is six or more letters, digits, hyphens and underscores with a digit among them. Behind the cue of a secret
    and a colon or equals sign it may be anything and of any length, up to the closing quote or the next blank.
    """
    if cue == "iban" and (found := iban(text, at)):
        return found
    value = VALUE.match(text, at)
    if value and any("0" <= c <= "9" for c in value[1]):
        return value.span(1)
    if cue in SECRETS and (value := SECRET.match(text, at)):
        start, end = value.span(value.lastindex)
        if value.lastindex == 3:
            end = start + len(text[start:end].rstrip(".!?"))
        return (start, end) if start < end else None
    return None


def grown(pattern: re.Pattern, text: str, at: int, floor: int, valid, out: list) -> int:
    """Add the valid match that begins at an anchor; where the next one may begin."""
    if at < floor or not (found := pattern.match(text, at)):
        return floor
    if valid(found[0]):
        out.append(found.span())
    return found.end()


def lower_ascii(text: str) -> str:
    """Lower case of the same length."""
    return text.lower() if text.isascii() else text.translate(ASCII_LOWER)


ASCII_LOWER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data, by kind and start, in code points."""
    text = text or ""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    floors = dict.fromkeys(KINDS, 0)
    for end, (kind, length) in automaton().iter(lower_ascii(text)):
        at = end - length + 1
        if kind == AT:
            if found := email(text, at, floors["email"]):
                out["email"].append(found)
                floors["email"] = found[1]
        elif kind == PLUS:
            floors["phone"] = grown(PHONE, text, at, floors["phone"], valid_phone, out["phone"])
        elif kind == DIGIT:
            # a grammar that fails at the first digit of a run fails at the others
            if at == 0 or not "0" <= text[at - 1] <= "9":
                floors["ip"] = grown(IP, text, at, floors["ip"], valid_ip, out["ip"])
                floors["card"] = grown(CARD, text, at, floors["card"], valid_card, out["card"])
        elif kind == SCHEME:
            if at >= floors["url"] and (at == 0 or not text[at - 1].isalnum()) and (rest := ADDRESS.match(text, end + 1)):
                stop = end + 1 + len(rest[0].rstrip(".,;:!?"))
                if stop > end + 1:
                    out["url"].append((at, stop))
                    floors["url"] = stop
        elif at >= floors["account"] and (at == 0 or not text[at - 1].isalnum()):
            if value := account(text, end + 1, text[at:end + 1].lower()):
                out["account"].append(value)
                floors["account"] = value[1]
    return [(kind, a, b) for kind in KINDS for a, b in out[kind]]


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """The rows with the list of spans of personal data in their text, each (kind, start, end) in code points.

    Spans are in the order of the kinds, then of their start; those of one kind do not overlap. A null or empty text has
    none; a very long one is searched whole. What counts as the value of an account is told at `account`. Rows are independent: repeated rows give repeated results, an empty table an empty one.
    """
    span = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ])
    added = T.StructType([T.StructField(out, T.ArrayType(span), False)])

    def compute(texts):
        return [[[{"kind": k, "start": a, "end": b} for k, a, b in spans(t)] for t in texts]]

    return add_columns(docs, text, added, compute)
