"""Personal data by anchor expansion: an Aho-Corasick automaton finds at-signs, digits, schemes and identifier cues in one
pass; a parser at each anchor expands it to both sides and validates what it found.

Base kinds (email, ip, card, phone) are the leftmost non-overlapping matches of their patterns, those that fail their
check left out. The anchors add four kinds: url (scheme://...), account (bank and identity numbers after a cue, or an IBAN
wherever it stands; each form has its own check), secret (issued keys by their beginning, private key blocks, and the
value after a cue such as `token =`, if it looks like one) and address (a street's name with its house number, a post box;
expanded over unit, town and postcode). Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "secret", "address")
#: Counts beside those of the base kinds.
PRIVATE = {"n_account": ("account",), "n_secret": ("secret",), "n_address": ("address",), "n_private": (*BASE_KINDS, "account", "secret", "address")}
#: Words that announce a secret or a number, in lower case; they are looked for in lower, upper, title and camel case.
SECRET_CUES = ("token", "password", "passwd", "pwd", "passphrase", "secret", "secret_key", "api_key", "api-key", "api key", "apikey", "access_key", "access key", "private_key", "private key", "bearer")
ACCOUNT_CUES = ("iban", "account", "acct", "routing", "sort code", "ssn", "social security", "passport")
#: Cues whose value may be as short as six characters, behind a colon or an equals sign.
SHORT_CUES = frozenset(("password", "passwd", "pwd"))
#: The beginnings of issued keys, and what follows them.
ISSUED = {
    "AKIA": r"[0-9A-Z]{16}(?![0-9A-Za-z])", "ASIA": r"[0-9A-Z]{16}(?![0-9A-Za-z])", "AIza": r"[0-9A-Za-z_-]{35}", "ghp_": r"[0-9A-Za-z]{36}", "gho_": r"[0-9A-Za-z]{36}", "ghs_": r"[0-9A-Za-z]{36}", "github_pat_": r"[0-9A-Za-z_]{22,}",
    "glpat-": r"[0-9A-Za-z_-]{20,}", "sk_live_": r"[0-9A-Za-z]{8,}", "sk_test_": r"[0-9A-Za-z]{8,}", "pk_live_": r"[0-9A-Za-z]{8,}", "rk_live_": r"[0-9A-Za-z]{8,}", "sk-": r"[0-9A-Za-z_-]{20,}",
    "xoxb-": r"[0-9A-Za-z-]{10,}", "xoxp-": r"[0-9A-Za-z-]{10,}", "eyJ": r"[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}", "-----BEGIN ": r"(?:[A-Z]+ )*PRIVATE KEY-----(?:[^-]*-----END (?:[A-Z]+ )*PRIVATE KEY-----)?",
}

#: What a street's name ends with, first words that say so, then those that need a town and postcode behind them, ...
STREETS = ("Street", "Avenue", "Road", "Boulevard", "Lane", "Terrace", "Crescent")
VAGUE_STREETS = ("Court", "Drive", "Square", "Parkway", "Highway", "St", "Ave", "Rd", "Blvd", "Ln", "Dr", "Ct", "Pkwy", "Hwy")
#: ... and the codes of states.
STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC"
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"://[^\s<>\"'`|\\^{}]+")
_BETWEEN = r"[\"']?[ \t]{0,4}(?:(?:[:=]|is|[Nn]o\.?|[Nn]umber|#)[\"']?[ \t]{0,4}){0,3}[\"']?"
_VALUE = re.compile(_BETWEEN + r"([A-Za-z0-9][A-Za-z0-9+/_-]{5,}=*)")
_PIECES = re.compile(r"[^+/_=-]+")
_ORDINAL = re.compile(r"[0-9]+(?:st|nd|rd|th)", re.I)
_NUMBER = re.compile(_BETWEEN + r"([A-Z]{0,2}[0-9](?:[ -]?[0-9A-Z]){5,33})(?![0-9A-Za-z])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]){11,30}(?![0-9A-Za-z])")
# After the cue an IBAN may be in any case, in one piece or in fours.
_ANY_IBAN = re.compile(_BETWEEN + r"([A-Za-z]{2}[0-9]{2}(?:[0-9A-Za-z]{11,30}|(?: [0-9A-Za-z]{4}){2,7}(?: [0-9A-Za-z]{1,3})?))(?![0-9A-Za-z])")
# House number and one to four words of the name, read back from the word for a street; each piece is of bounded length.
_BEFORE_STREET = re.compile(r"(?<![0-9A-Za-z.,/$€£-])([1-9][0-9]{0,4})[A-Za-z]?(?: (?:[A-Z][A-Za-z'’-]{0,23}\.?|[0-9]{1,3}(?:st|nd|rd|th))){1,4} \Z")
_BEFORE_REACH = 120
_QUARTER = re.compile(r" (?:NE|NW|SE|SW)(?![0-9A-Za-z])")
_UNIT = re.compile(r",? (?:(?:Apt|Apartment|Suite|Ste|Unit|Floor|Flat)\.? ?|# ?)[0-9A-Za-z-]{1,6}(?![0-9A-Za-z])")
_TOWN = re.compile(
    r"(?:,?[ \n]|, ?\n)[A-Z][A-Za-z'’.-]{1,23}(?: [A-Z][A-Za-z'’.-]{1,23}){0,3},?[ \n](?:(?:" + STATES.replace(" ", "|") + r"),? [0-9]{5}(?:-[0-9]{4})?|[A-Z]{1,2}[0-9][0-9A-Z]? [0-9][A-Z]{2})(?![0-9A-Za-z])"
)
# What goes on behind a street without a town: the end, a stop, or a small word. `5 Wall Street banks` is no address.
_AFTER_STREET = re.compile(r"\s*(?:\Z|[\n,.;:!?)\"'])| (?:and|at|by|for|in|is|near|on|or|to|was|with)(?![A-Za-z])")
_BOX = re.compile(r"Box [0-9]{1,6}(?![0-9A-Za-z])", re.I)
_BEFORE_BOX = re.compile(r"(?<![0-9A-Za-z])(?:P\. ?O\.|PO|Post Office) \Z", re.I)
_ISSUED = {sign: re.compile(re.escape(sign) + rest) for sign, rest in ISSUED.items()}
_NOT_DIGIT = re.compile(r"[^0-9]")
#: IBAN lengths by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}


def _camel(cue: str) -> tuple[str, str]:
    """A cue of several words as one: apiKey, ApiKey."""
    joined = "".join(x.capitalize() for x in re.split("[ _-]", cue))
    return joined[0].lower() + joined[1:], joined


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign in ("@", "://", "+", *sorted(_DIGITS)):
        found.add_word(sign, (sign, len(sign)))
    for sign in ISSUED:
        found.add_word(sign, (sign, len(sign)))
    for country in IBAN_LENGTHS:
        found.add_word(country, ("country", 2))
    for kind, cues in (("secret cue", SECRET_CUES), ("account cue", ACCOUNT_CUES)):
        for form in {f for cue in cues for f in (cue, cue.upper(), cue.title(), cue.capitalize(), *_camel(cue))}:
            found.add_word(form, (kind, len(form)))
    for words in (STREETS, VAGUE_STREETS):
        for word in words:
            for form in (word, word.upper()):
                found.add_word(form, ("street", len(form)))
    found.add_word("Box ", ("box", 4))
    found.add_word("BOX ", ("box", 4))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    doubled = [int(x) * 2 for x in digits[-2::-2]]
    return (sum(int(x) for x in digits[-1::-2]) + sum(x - 9 if x > 9 else x for x in doubled)) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _iban(text: str, at: int) -> int | None:
    """End of the IBAN that begins at `at`: its country's length, and 1 modulo 97 with the first four characters moved to the end."""
    if not (m := _IBAN.match(text, at)):
        return None
    end, left = at, IBAN_LENGTHS[text[at : at + 2]]
    while left and end < m.end():
        left -= text[end] != " "
        end += 1
    plain = text[at:end].replace(" ", "")
    if left or (end < len(text) and text[end].isascii() and text[end].isalnum()):
        return None
    return end if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 else None


def _account(cue: str, value: str) -> bool:
    """Whether the value after a cue has the form and the check digits of its kind."""
    plain = value.replace(" ", "").replace("-", "")
    digits = plain.isdigit()
    if cue in ("ssn", "social security", "socialsecurity"):
        return digits and len(plain) == 9 and plain[:3] not in ("000", "666") and plain[0] != "9" and plain[3:5] != "00" and plain[5:] != "0000"
    if cue == "routing":
        return digits and len(plain) == 9 and sum(int(x) * w for x, w in zip(plain, (3, 7, 1) * 3, strict=True)) % 10 == 0
    if cue == "passport":
        return 6 <= len(plain) <= 9 and sum(x.isdigit() for x in plain) >= 5
    if cue in ("sort code", "sortcode"):
        return digits and len(plain) == 6
    if cue == "iban":
        return False  # an IBAN is found by its own form, with its check digits
    return digits and 6 <= len(plain) <= 17


def _secret(cue: str, between: str, value: str) -> bool:
    """Whether the value after a cue is no word: letters and digits mixed, ordinals apart (18th-century).

    Without a colon or an equals sign one piece of it has to mix them (covid-19 doesn't), and it has eight characters. Those
    are also needed after a sign, but for a password.
    """
    told = ":" in between or "=" in between
    if not between or len(value) < (6 if told and cue in SHORT_CUES else 8):
        return False
    pieces = [x for x in _PIECES.findall(value) if not _ORDINAL.fullmatch(x)]
    return any(not _DIGITS.isdisjoint(x) and any(c.isalpha() for c in x) for x in (["".join(pieces)] if told else pieces))


def _begins(text: str, at: int) -> bool:
    """Whether a word begins at the place, one inside a name in camel case included."""
    return at == 0 or not text[at - 1].isalnum() or (text[at].isupper() and text[at - 1].islower())


def _told_iban(text: str, at: int) -> tuple[int, int] | None:
    """The IBAN in any case that follows a cue which ends before `at`."""
    if not (m := _ANY_IBAN.match(text, at)) or m.start(1) == at:
        return None
    end = None
    if m[1][:2].upper() in IBAN_LENGTHS:
        end = _iban(m[1].upper(), 0)
    return (m.start(1), m.start(1) + end) if end else None


def _address(text: str, at: int, end: int, done: int) -> tuple[int, int] | None:
    """The address around the word for a street at [at, end), after `done`: number and name before it, unit, town and postcode behind.

    A town with its postcode is needed behind a vague word (Dr, Court) and, without a quarter, a number that may be a year.
    """
    begin = max(done, at - _BEFORE_REACH)
    vague = text[at:end].title() in VAGUE_STREETS
    if text[end : end + 1].isalnum() or not (m := _BEFORE_STREET.search(text[begin:at])):
        return None
    if vague and text.startswith(".", end):
        end += 1
    if quarter := _QUARTER.match(text, end):
        end = quarter.end()
    if unit := _UNIT.match(text, end):
        end = unit.end()
    if town := _TOWN.match(text, end):
        end = town.end()
    elif vague or (1500 <= int(m[1]) <= 2099 and not quarter) or not (unit or _AFTER_STREET.match(text, end)):
        return None
    return begin + m.start(), end


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end), by kind as in KINDS, then start."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)
    for last, (sign, width) in _anchors().iter(text):
        at = last - width + 1
        if sign in _DIGITS:
            if at >= done["card"] and (m := _CARD.match(text, at)):
                done["card"] = m.end()
                digits = _NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    spans["card"].append(m.span())
            if at >= done["ip"] and (at == 0 or text[at - 1] not in _DIGITS) and (m := _IP.match(text, at)):
                done["ip"] = m.end()
                if all(map(_small, m.groups())):
                    spans["ip"].append(m.span())
        elif sign == "@":
            start = at
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                done["email"] = m.end()
                spans["email"].append((start, m.end()))
        elif sign == "+":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    spans["phone"].append(m.span())
        elif sign == "://":
            start = at
            while start > done["url"] and at - start < 12 and text[start - 1] in _LETTERS:
                start -= 1
            if start < at and (m := _URL.match(text, at)):
                end = start + len(text[start : m.end()].rstrip(".,;:!?)]"))
                done["url"] = m.end()
                if end > at + 3:
                    spans["url"].append((start, end))
        elif sign == "country":
            if at >= done["account"] and (at == 0 or not text[at - 1].isalnum()) and (end := _iban(text, at)):
                done["account"] = end
                spans["account"].append((at, end))
        elif sign == "account cue":
            if at >= done["account"] and _begins(text, at):
                cue = text[at : last + 1].lower().replace("acct", "account")
                got = _told_iban(text, last + 1) if cue == "iban" else None
                if not got and (m := _NUMBER.match(text, last + 1)) and _account(cue, m[1]):
                    got = m.span(1)
                if got:
                    done["account"] = got[1]
                    spans["account"].append(got)
        elif sign == "street":
            if at >= done["address"] and not text[at - 1 : at].isalnum() and (got := _address(text, at, last + 1, done["address"])):
                done["address"] = got[1]
                spans["address"].append(got)
        elif sign == "box":
            begin = max(done["address"], at - 12)
            if at >= done["address"] and (m := _BOX.match(text, at)) and (b := _BEFORE_BOX.search(text[begin:at])):
                done["address"] = (_TOWN.match(text, m.end()) or m).end()
                spans["address"].append((begin + b.start(), done["address"]))
        elif sign == "secret cue":
            if at >= done["secret"] and _begins(text, at) and (m := _VALUE.match(text, last + 1)) and _secret(text[at : last + 1].lower(), text[last + 1 : m.start(1)], m[1]):
                done["secret"] = m.end()
                spans["secret"].append(m.span(1))
        elif at >= done["secret"] and (at == 0 or not text[at - 1].isalnum()) and (m := _ISSUED[sign].match(text, at)):
            done["secret"] = m.end()
            spans["secret"].append(m.span())
    return [(k, a, b) for k in KINDS for a, b in spans[k]]


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by <kind>; of overlapping spans the one that starts first (then the longest) counts."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
            at = b
    return "".join([*out, text[at:]])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_masked: bool = False) -> DataFrame:
    """doc_id, a count for each base kind, base_sha256, spans (all kinds, kind:start:end joined by commas), n_account, n_secret, n_address, n_private (spans of all kinds but url), and the masked text if asked for.

    One row per input row, with no shuffle. Null texts count as empty (no spans); repeated rows stay; an empty table gives
    an empty result; other columns are not read.
    """

    def each(batches):
        for batch in batches:
            counts, digests, joined, masked = [[] for _ in (*BASE_KINDS, *PRIVATE)], [], [], []
            for some in texts(batch.column(1)):
                for text in some:
                    spans = find(text)
                    for k, kinds in enumerate((*((x,) for x in BASE_KINDS), *PRIVATE.values())):
                        counts[k].append(sum(x[0] in kinds for x in spans))
                    base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans if k in BASE_KINDS)
                    digests.append(hashlib.sha256(base.encode()).hexdigest())
                    joined.append(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
                    if with_masked:
                        masked.append(mask(text, spans))
            held, more = counts[: len(BASE_KINDS)], counts[len(BASE_KINDS) :]
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in held), pa.array(digests, pa.string()), pa.array(joined, pa.string()), *(pa.array(x, pa.int64()) for x in more), *([pa.array(masked, pa.string())] if with_masked else [])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", *PRIVATE, *(["masked_text"] if with_masked else [])]
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string, " + ", ".join(f"{x} long" for x in PRIVATE) + ", masked_text string" * with_masked
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(each, schema)
