"""Pattern spans of personal data: the base that the tagger learns from and that always stays.

Fixed patterns: email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, ip ``[0-9]+`` four times with
dots, parts at most 255, card ``[0-9]([\\x20-]?[0-9])+`` with 13 to 19 digits and a right check digit, phone
``\\+[0-9][\\x20().0-9-]+[0-9]`` with 9 to 15 digits. Matches are leftmost and do not overlap within a kind;
a match that fails its check is dropped and not tried again. The searches below give these matches in
time linear in the text, whatever it holds.
"""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AT = re.compile("@")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a match can only begin where a run of digits begins, which keeps long runs linear
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]*[0-9]")
DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in text.split("."))


def is_card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= len(DIGITS.findall(text)) <= 15


def emails(text: str) -> list[Span]:
    """For each at sign: the longest local part before it that is not taken, and the domain behind it."""
    out, taken = [], 0
    for m in AT.finditer(text):
        at = m.start()
        start = at
        while start > taken and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            out.append((0, start, domain.end()))
            taken = domain.end()
    return out


def base_spans(text: str) -> list[Span]:
    out = emails(text)
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if is_ip(m.group())]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if is_card(m.group())]
    # plus, digit, at least one more sign, digit
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if m.end() - m.start() >= 4 and is_phone(m.group())]
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


# what a span found by the tagger must look like, besides being tagged
AT_WORD = re.compile(r"\s*(?:@|\[at\]|\(at\))\s*", re.IGNORECASE)
DOT_WORD = re.compile(r"\s*(?:\.|\[dot\]|\(dot\))\s*", re.IGNORECASE)
MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def plausible(kind: int, text: str) -> bool:
    """Whether a tagged span passes the check of its kind, with separators that the patterns do not know."""
    digits = "".join(DIGITS.findall(text))
    if kind == 0:
        return len(text) <= 120 and bool(MAIL.fullmatch(DOT_WORD.sub(".", AT_WORD.sub("@", text))))
    if len(text) > 40 or any(c.isalpha() for c in text):
        return False
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and is_ip(".".join(parts))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and not text.isdigit()
