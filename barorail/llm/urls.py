"""URL filters: all glob rules run at once over a URL in a bit-parallel Shift-And automaton."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows

ONE = np.uint64(1)
TOP = np.uint64(63)


@dataclass(frozen=True)
class HostRule:
    """``host/path``: the host and its subdomains, where the URL's path starts with the rule's."""

    text: str
    verdict: str

    def globs(self) -> tuple[str, str]:
        return f"{self.text}**", f"*.{self.text}**"


#: Rules of the query; the longest that fits decides.
RULES = (
    HostRule("net/", "block"),
    HostRule("example.net/en/", "allow"),
    HostRule("example.com/de/", "block"),
    HostRule("org/fr/", "allow"),
)

#: Globs over ``host/path`` that block what no rule decides.
BLOCKED = ("*casino*/**", "*porn*/**", "*viagra*/**", "**/wp-login.php**", "**/cgi-bin/**", "**.exe")


class ShiftAnd:
    """Globs packed side by side into words of 64 bits.

    A glob of m characters takes m + 1 bits, bit i standing for "its first i characters are read". A
    character moves every set bit on by one where the mask of that character allows it; a bit below a
    star stays set on every character (``**``) or on any but ``/`` (``*``); ``?`` is any one character.
    """

    def __init__(self, globs: Sequence[str]):
        parsed = [self._parse(g) for g in globs]
        self.chars = np.array(sorted({ord(c) for chars, _ in parsed for c in chars if c} | {ord("/")}), np.uint32)
        words = max(1, -(-sum(len(chars) + 1 for chars, _ in parsed) // 64))
        classes = len(self.chars) + 1  # class 0: characters that no glob names
        self.move = np.zeros((classes, words), np.uint64)
        self.stay = np.zeros((classes, words), np.uint64)
        self.first = np.zeros(words, np.uint64)
        self.last: list[int] = []
        slash = self._classes(np.array([ord("/")], np.uint32))[0]
        bit = 0
        for chars, stars in parsed:
            self._set(self.first, bit)
            for i in range(len(chars) + 1):
                if i in stars:
                    for c in range(classes):
                        if stars[i] == "**" or c != slash:
                            self._set(self.stay[c], bit + i)
                if i < len(chars):
                    for c in range(classes) if not chars[i] else self._classes(np.array([ord(chars[i])], np.uint32)):
                        self._set(self.move[c], bit + i + 1)
            bit += len(chars)
            self.last.append(bit)
            bit += 1

    @staticmethod
    def _parse(glob: str) -> tuple[list[str], dict[int, str]]:
        chars: list[str] = []
        stars: dict[int, str] = {}
        for c in glob:
            if c == "*":
                stars[len(chars)] = "**" if len(chars) in stars else "*"
            else:
                chars.append("" if c == "?" else c)
        return chars, stars

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= ONE << np.uint64(bit % 64)

    def _classes(self, codes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.chars, codes).clip(max=len(self.chars) - 1)
        return np.where(self.chars[at] == codes, at + 1, 0)

    def fits(self, texts: Sequence[str]) -> np.ndarray:
        """For each text and glob whether the glob fits the whole text."""
        codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        sizes = np.array([len(c) for c in codes], np.int64)
        order = np.argsort(-sizes, kind="stable")
        starts = np.concatenate([[0], np.cumsum(sizes[order])])[:-1]
        flat = self._classes(np.concatenate([codes[i] for i in order])) if sizes.sum() else np.zeros(0, np.int64)
        state = np.tile(self.first, (len(texts), 1))
        left = sizes[order]
        for at in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-left, -at, side="left"))  # texts longer than ``at``
            now, c = state[:n], flat[starts[:n] + at]
            moved = now << ONE
            moved[:, 1:] |= now[:, :-1] >> TOP
            state[:n] = (moved & self.move[c]) | (now & self.stay[c])
        found = np.zeros((len(texts), len(self.last)), bool)
        for g, bit in enumerate(self.last):
            found[order, g] = (state[:, bit // 64] >> np.uint64(bit % 64)) & ONE == ONE
        return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for NULL and where there is no ``://``; only A-Z of the host are lower-cased."""
    found = F.coalesce(url, F.lit("")).contains("://")
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(found, lowered).otherwise(""), F.when(found, path).otherwise("")


def judge_urls(
    pages: DataFrame, rules: Sequence[HostRule] = RULES, blocked: Sequence[str] = BLOCKED
) -> DataFrame:
    """page_id, host, path, rule, verdict, blocked_by of every row.

    The longest rule that fits gives the verdict, of equally long ones the first listed. Without a rule
    (NULL) a URL is blocked if one of the globs ``blocked`` fits, the first of which is then ``blocked_by``
    (else NULL), and allowed otherwise. A NULL URL has an empty host and path and is allowed. Repeated
    rows stay, other columns are ignored, an empty table gives no rows.
    """
    globs = [(g, r.text, r.verdict) for r in sorted(rules, key=lambda r: -len(r.text)) for g in r.globs()]
    globs += [(g, None, "block") for g in blocked]
    host, path = host_and_path(F.col("url"))
    automaton = ShiftAnd([g for g, _, _ in globs])

    def judge(page_ids, hosts, paths):
        found = automaton.fits([h + p for h, p in zip(hosts, paths)])
        any_fit, first = found.any(axis=1), found.argmax(axis=1)
        for page_id, h, p, fit, i in zip(page_ids, hosts, paths, any_fit.tolist(), first.tolist()):
            glob, rule, verdict = globs[i] if fit else (None, None, "allow")
            yield page_id, h, p, rule, verdict, None if rule else glob

    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return map_rows(
        parts, judge, f"page_id {kind}, host string, path string, rule string, verdict string, blocked_by string"
    )
