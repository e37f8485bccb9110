"""Repairing text that came from scanned pages.

Words, word pairs and line templates are counted over the distinct values.
Skip-gram vectors come from the counts of words within ``WINDOW`` places of
one another: the shifted positive pointwise information that skip-gram with
negative sampling factorises, factored by its leading eigenvectors. A rare
word, too seldom for a vector of its own, has the mean of the vectors around
it; its neighbours among the more frequent words are those that score high
there, and one with the same strokes (a plausible glyph edit) corrects it.
Words broken or spaced apart are joined when the whole is far likelier than
its parts side by side; then page furniture is removed and lines reflowed.

Frequent words, pairs and heads are broadcast: at most 1/f of them can be as
frequent as f. What a text asks of rarer ones is answered by a join, so all of
the corpus counts at any size. Texts without anything to ask or mend, most of
them, leave the data flow after one look.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_schema, keep
from . import lookalikes

#: Relative frequency from which words, pairs and heads are broadcast, and from which a word is a context of the vectors. Rarer ones are asked for.
HOT_SHARE, CONTEXT_SHARE = 2e-5, 5e-4
#: Uses that make a word, a pair or a running head.
LEAST = 3
#: A misread form is at least so many times rarer than the word it stands for.
RARER = 20
#: How often a scan parts a word, at most: parts side by side are one word if that is likelier than both words by chance.
PARTED = 1e-4
DIM, WINDOW = 32, 4
#: Mean association with the words around it from which a neighbour corrects a rare word.
FITS = 0.0
#: A context as frequent as this counts half as much as a rare one.
HALF_WEIGHT = 1e-3
#: Uses of a line template in distinct texts that make it a running head.
HEAD_LEAST = 2
#: Entries a task counts before it passes them on.
FLUSH = 400_000

# Strokes of characters that scanners mistake for one another. A
# character is spelled out in strokes, so that rn = m, cl = d, li = h, ii = u, vv = w.
STROKES = {"0": "o", "1": "l", "|": "l", "!": "l", "i": "l", "5": "s", "8": "ll", "2": "z", "9": "g", "c": "e", "f": "e", "d": "el", "u": "ll", "h": "ll", "b": "ll", "m": "rn", "w": "vv"}
_SIX = ("ll", "g")
# The same for words in capitals, so that D = O and IVI = M.
CAPITALS = {"0": "O", "D": "O", "Q": "O", "1": "I", "|": "I", "!": "I", "L": "I", "5": "S", "8": "B", "6": "G", "C": "G", "2": "Z", "F": "E", "M": "IVI", "W": "VV"}
# Words after a hyphen that stands for a word to come.
SUSPENDED = ("and", "or", "to")
_PUNCT = ".,;:?\"“”()[]{}’‘'…«»"
_TOKEN = re.compile(r"[^ \t\n\r\f\x0b]+")
_BREAK = re.compile(r"(?<![^\s(“\"])([^\s(“\"]*[^\W_])\s?([-¬])(\s+)([^\s]*[^\W_|!][^\s]*)|([^\s(“\"]*[^\W_])¬([^\s]+)")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_]+-)?[^\W\d_](?: [^\W\d_]){2,}(?:-[^\W\d_]+)?(?=$|\s|[.,;:?!)])")
_END = re.compile(r"[\w)\]”’\"'%°][.!?][\"”’)»\]]*\s*$")
_NUMBER_LINE = re.compile(r"^\W*(?:[Pp](?:age|AGE|\.)?\s*)?\d{1,4}(?:\s*(?:of|OF)\s*\d{1,4})?\W*$")
_INLINE = re.compile(r"(?:_{3,}[ \t]*\d{1,4}\b)|(?:(?<=\s)\[\d{1,4}\](?=\s|$))|(?:(?<=\s)[-–] ?\d{1,4} ?[-–](?=\s|$))|(?:(?<![(\w] )\b(?:Page|PAGE) \d{1,4}(?: (?:of|OF) \d{1,4})?\b)")
_BARE = re.compile(r"\s+\d{1,3}\s+(?=(\S+))")
_SIGN = re.compile(r"[-¬](?=\s)|¬")
_HALVES = re.compile(r"(?<!\S)(\S*[-¬])\s+(?=(\S+))")
_LIKE = re.compile(f"[¬{lookalikes.IGNORABLE}{lookalikes.HYPHENS}{lookalikes.LIKE_FROM}]")
_LINE = re.compile(r"[\n\f]")
_LETTERS = re.compile(r"[^\W\d_]+")
_SEP = "\t"
CLEAR, WORD, DIGIT, HALF, LETTER, HEAD, PAGE = 0, 1, 2, 4, 8, 16, 32


def plain(value: str) -> str:
    """Without the characters that only look like others; case and line ends stay."""
    if value.isascii() or (unicodedata.is_normalized("NFKC", value) and not _LIKE.search(value)):
        return value
    value = unicodedata.normalize("NFKC", lookalikes._IGNORABLE.sub("", value).replace("¬", "")).replace("", "¬")
    return lookalikes._RUN.sub(lookalikes._latin, lookalikes._HYPHEN.sub("-", value))


def strokes(word: str) -> set[str]:
    word = word.lower()
    # Two n are also read as r and m.
    return {"".join(STROKES.get(c, six if c == "6" else c) for c in word).replace("nn", "rrn") for six in (_SIX if "6" in word else _SIX[:1])}


def capital_strokes(word: str) -> str:
    return "".join(CAPITALS.get(c, c) for c in word.upper())


def in_capitals(word: str) -> bool:
    letters = [c for c in word if c.isalpha()]
    return len(letters) > 1 and all(c.isupper() for c in letters)


def shapes(word: str) -> set[str]:
    """Keys two words share if one may be misread as the other; capitals have keys of their own."""
    return strokes(word) | {"^" + capital_strokes(word)}


def core(token: str) -> str:
    return token.strip(_PUNCT)


def word_of(token: str) -> str:
    """What a token counts as: a lower-case word, # for a number, '' for a sign."""
    w = core(token).lower()
    w = w.rstrip("!") if w.endswith("!") else w
    return "#" if w.isdigit() else w


def head_of(line: str) -> str:
    """A line's template if it could be a running head with its number, else ''."""
    line = " ".join(line.split())
    if len(line) < 4 or line[-1] in ".!?,;:" or not re.search(r"\d", line):
        return ""
    words = _LETTERS.findall(line)
    if not any(len(w) >= 4 for w in words) or any(len(w) >= 4 and not w[0].isupper() for w in words):
        return ""
    return re.sub(r"\b[A-Z]\b", "@", re.sub(r"\d+", "#", line))


def _heads_in(text: str) -> list[str]:
    lines = re.split(r"[\n\r\f]+", text)
    return [h for h in map(head_of, lines) if h] if len(lines) > 1 else []


@dataclass
class Model:
    """What the corpus taught about its frequent words; ``asked`` holds one text's answers about rarer ones."""

    total: int = 1
    words: dict[str, int] = field(default_factory=dict)
    pairs: dict[tuple[str, str], int] = field(default_factory=dict)
    heads: set[str] = field(default_factory=set)
    vectors: dict[str, np.ndarray] = field(default_factory=dict)
    contexts: dict[str, np.ndarray] = field(default_factory=dict)
    least: float = LEAST

    def __post_init__(self):
        self.asked_words: dict[str, int] = {}
        self.asked_mates: dict[str, list[tuple[str, int, np.ndarray | None]]] = {}
        self.asked_pairs: dict[tuple[str, str], int] = {}
        self.asked_heads: set[str] = set()
        self.mates: dict[str, list[str]] = {}
        for w in sorted(self.words, key=lambda w: (-self.words[w], w)):
            if any(c.isalpha() for c in w):
                for s in shapes(w):
                    self.mates.setdefault(s, []).append(w)
        self.lengths = sorted({len(h.split()) for h in self.heads}, reverse=True)
        # A head is only in a text that holds its longest word.
        self.anchors = {max(_LETTERS.findall(h), key=len) for h in self.heads}
        self.clear: dict[str, int] = {}
        self.good = {w for w in self.words if self.words[w] >= LEAST and not any(self.words[c] > RARER * self.words[w] for s in strokes(w) for c in self.mates.get(s, ())[:1])}

    def count(self, word: str) -> int:
        return self.words.get(word) or self.asked_words.get(word, 0)

    def pair(self, a: str, b: str) -> int:
        return self.pairs.get((a, b)) or self.asked_pairs.get((a, b), 0)

    def kind(self, token: str) -> int:
        """What a raw token may need: a look at the word, at numbers and furniture, at a break, at spaced letters; CLEAR if nothing."""
        k = self.clear.get(token)
        if k is None:
            if len(self.clear) > FLUSH:
                self.clear.clear()
            k = self.clear[token] = self._kind(token)
        return k

    def _kind(self, token: str) -> int:
        kind = CLEAR
        if any(c.isdigit() for c in token) or "__" in token:
            kind |= DIGIT
        if token[-1] in "-¬" or "¬" in token:
            kind |= HALF
        if token[0] in "[-–" or "__" in token or "Page" in token or "PAGE" in token:
            kind |= PAGE
        if len(token) == 1 and token.isalpha():
            kind |= LETTER
        if not self.anchors.isdisjoint(_LETTERS.findall(token)):
            kind |= HEAD
        low = core(token).lower()
        if low and any(c.isalpha() for c in low) and low not in self.good and low.rstrip("!") not in self.good:
            kind |= WORD
        return kind

    def known(self, word: str) -> bool:
        """Attested, and not a misreading of something far more frequent."""
        if word in self.words:
            return word in self.good
        n = self.asked_words.get(word, 0)
        return n >= LEAST and not any(m > RARER * n for _, m, _ in self.options(word))

    def options(self, word: str, capitals: bool = False) -> list[tuple[str, int, np.ndarray | None]]:
        """More frequent words with the same strokes: word, count and vector."""
        low, n = word.lower(), self.count(word.lower())
        keys = strokes(low) | ({"^" + capital_strokes(word)} if capitals else set())
        hot = {c: (c, self.words[c], self.vectors.get(c)) for k in keys for c in self.mates.get(k, ())}
        rare = {c: (c, m, v) for c, m, v in self.asked_mates.get(low, ()) if keys & shapes(c)}
        return [x for c, x in sorted((hot | rare).items()) if c != low and x[1] >= LEAST and x[1] > RARER * n]

    def fix(self, word: str, context: Sequence[str]) -> str | None:
        """The neighbour of the word's place with its strokes; None if none fits there."""
        options = self.options(word, in_capitals(word))
        if not options:
            return None
        near = [self.contexts[w] for w in map(self.seen_as, context) if w in self.contexts]
        if not near:
            return None
        place = _unit(np.sum(near, axis=0))
        score = lambda v: float(place @ v) if v is not None else 0.0
        fit, _, best = max((score(v), m, c) for c, m, v in options)
        return best if fit >= FITS else None

    def seen_as(self, token: str) -> str:
        """The context a token stands for; a misread one for its most frequent neighbour in shape."""
        w = word_of(token)
        if w in self.contexts or w in self.good or not w or w == "#":
            return w
        options = self.options(core(token), in_capitals(core(token)))
        return max(options, key=lambda x: (x[1], x[0]))[0] if options else w


def _unit(v: np.ndarray) -> np.ndarray:
    return v / (np.linalg.norm(v) or 1.0)


def _cased(new: str, old: str) -> str:
    if in_capitals(old):
        return new.upper()
    letters = [c for c in old if c.isalpha()]
    return new[0].upper() + new[1:] if letters and old[0].isupper() else new


# ---- furniture ----
def _windows(toks: list[str], lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Spans of tokens around numbers that may be a head inside running text, longest first."""
    at = [i for i, t in enumerate(toks) if any(c.isdigit() for c in t)]
    for n in lengths:
        seen = set()
        for i in at:
            for lo in range(max(0, i - n + 1), min(i, len(toks) - n) + 1):
                if lo not in seen:
                    seen.add(lo)
                    yield lo, lo + n


def _inline_heads(text: str, m: Model) -> str:
    """Without the frequent heads inside its lines, unless nothing else would be left."""
    spans = [(t.start(), t.end()) for t in _TOKEN.finditer(text)]
    toks = [text[a:b] for a, b in spans]
    taken: list[tuple[int, int]] = []
    for lo, hi in _windows(toks, m.lengths):
        if any(lo < b and a < hi for a, b in taken):
            continue
        lead, tail = re.match(r"\W*", toks[lo])[0] if toks[lo][0] not in "#" else "", ""
        last = toks[hi - 1]
        # Punctuation of the sentence around stays with the sentence.
        while last and last[-1] in ".,;:!?)”’\"" and head_of(" ".join([toks[lo][len(lead) :], *toks[lo + 1 : hi - 1], last] if hi - lo > 1 else [last])) not in m.heads:
            tail, last = last[-1] + tail, last[:-1]
        first = toks[lo][len(lead) :]
        phrase = " ".join([first, *toks[lo + 1 : hi - 1], last]) if hi - lo > 1 else last
        if head_of(phrase) in m.heads:
            taken.append((lo, hi))
    if not taken or sum(hi - lo for lo, hi in taken) == len(toks):
        return text
    out, at = [], 0
    for lo, hi in sorted(taken):
        end = spans[hi - 1][1]
        trail = re.search(r"[.,;:!?)”’\"]*$", toks[hi - 1])[0]
        if toks[hi - 1] and trail and head_of(" ".join(toks[lo:hi])) in m.heads:
            trail = ""
        out.append(text[at : spans[lo][0]] + " ")
        at = end - len(trail)
    return "".join(out) + text[at:]


def strip_furniture(text: str, m: Model) -> tuple[str, bool]:
    """Without page numbers and running heads on lines of their own and inside lines; whether there were any."""
    found = False
    lines = _LINE.split(text)
    if len(lines) > 1:
        kept = [x for x in lines if not (_NUMBER_LINE.match(x) or ((h := head_of(x)) and (h in m.heads or h in m.asked_heads)))]
        found = len(kept) < len(lines)
        text = "\n".join(kept) if found else text.replace("\f", "\n")
    if any(c.isdigit() for c in text):
        bare = text if m.anchors.isdisjoint(_LETTERS.findall(text)) else _inline_heads(text, m)
        bare = _INLINE.sub(" ", bare) if any(m.kind(t) & PAGE for t in bare.split()) else bare
        found, text = found or bare != text, bare
    return text, found


def _strip_numbers(text: str, m: Model) -> tuple[str, bool]:
    """Without bare page numbers between two words that hardly ever have a number beside them."""
    found = False

    def number(x: re.Match) -> str:
        nonlocal found
        before = _token_before(x.string, x.start())
        a, b = core(before).lower(), core(x[1]).lower()
        if before and before[-1] not in ".,;:":
            n = m.pair(a, b)
            if n >= LEAST and RARER * m.pair(a, "#") < n and RARER * m.pair("#", b) < n:
                found = True
                return " "
        return x[0]

    return _BARE.sub(number, text), found


def _token_before(text: str, at: int) -> str:
    lo = at
    while lo and not text[lo - 1].isspace():
        lo -= 1
    return text[lo:at]


def _breaks(text: str) -> Iterator[re.Match]:
    """Matches of a broken word, looked for only beside a hyphen before white space and the not sign."""
    done = 0
    for x in _SIGN.finditer(text):
        lo, hi, n = x.start(), x.end(), len(text)
        if lo < done:
            continue
        lo -= lo > done and text[lo - 1].isspace()
        while lo > done and not text[lo - 1].isspace():
            lo -= 1
        while hi < n and text[hi].isspace():
            hi += 1
        while hi < n and not text[hi].isspace():
            hi += 1
        if got := _BREAK.search(text, lo, hi):
            yield got
            done = got.end()


def _is_suspended(x: re.Match, m: Model) -> bool:
    """Whether a hyphen stands for a word to come, as in short- and long-term."""
    if x[2] != "-" or core(x[4]).lower() not in SUSPENDED or core(x[4]).lower() not in m.good:
        return False
    then = x.string[x.end() :].split(None, 1)[:1]
    return bool(then) and "-" in core(then[0])[1:-1]


def _join_breaks(text: str, of) -> str:
    out, at = [], 0
    for x in _breaks(text):
        out += [text[at : x.start()], of(x)]
        at = x.end()
    return "".join(out) + text[at:]


def _letters_apart(toks: Sequence[str]) -> bool:
    return len({t for t in toks if len(t) == 1 and t.isalpha()}) > 1


# ---- words ----
def mend(text: str, m: Model, cut_off: bool) -> tuple[str, list[str]]:
    """Words broken, spaced apart or misread put right, in text without furniture."""
    found: list[str] = []

    def around(x: re.Match) -> list[str]:
        return x.string[: x.start()].rsplit(None, WINDOW)[-WINDOW:] + x.string[x.end() :].split(None, WINDOW)[:WINDOW]

    def whole(word: str, context: Sequence[str]) -> str | None:
        low = core(word).lower()
        if m.known(low) or m.known(low.rstrip("!")):
            return word
        good = m.fix(core(word), context) if low else None
        return word.replace(core(word), _cased(good, core(word))) if good else None

    def broken(x: re.Match) -> str:
        if _is_suspended(x, m):
            return x[0]
        left, right = (x[1], x[4]) if x[1] is not None else (x[5], x[6])
        sign, gap = (x[2], x[3]) if x[1] is not None else ("¬", "")
        near = around(x)
        joined = whole(left + right, near)
        a, b = core(left).lower(), core(right).lower()
        if joined and (sign == "¬" or not m.known(f"{a}-{b}")):
            if not (m.known(a) and m.known(b) and b in SUSPENDED):
                found.append("broken")
                return joined
        if m.known(f"{a}-{b}") or ("-" in a and m.known(a) and m.known(b)):
            return f"{left}-{right}" if "\n" in gap else x[0]
        tail = a.rsplit("-", 1)
        head = re.match(r"([^-]+)-(.+)", b)
        part = (len(tail) == 2 and whole(tail[1] + right, near)) or (head and whole(left + core(right).split("-", 1)[0], near))
        if part or sign == "¬" or ("\n" in gap and not m.known(a) and not m.known(b)):
            found.append("broken")
            return left + right
        return x[0]

    for _ in range(3):
        again = _join_breaks(text, broken)
        if again == text:
            break
        text = again

    def spaced(x: re.Match) -> str:
        bits = x[0].split(" ")
        # A one-letter word may stand right before or after a spaced-out one.
        for lo, hi in ((0, len(bits)), (0, len(bits) - 1), (1, len(bits))):
            got = whole("".join(bits[lo:hi]), around(x)) if hi - lo > 2 else None
            if got:
                found.append("spaced")
                return " ".join([*bits[:lo], got, *bits[hi:]])
        return x[0]

    text = _SPACED.sub(spaced, text) if _letters_apart(text.split()) else text
    spans = [(t.start(), t.end(), t.group()) for t in _TOKEN.finditer(text)]
    cores = [core(t[2]).lower() for t in spans]
    # The last word of a text cut off; a mark of the cut may follow it.
    final = max((i for i, w in enumerate(cores) if w), default=0) if cut_off else len(spans)
    out, at, skip = [], 0, -1
    for i, (s, e, t) in enumerate(spans):
        if i <= skip or (not m.kind(t) & WORD and (i + 1 == len(spans) or not m.kind(spans[i + 1][2]) & WORD)):
            continue
        c, low, fresh = core(t), cores[i], None
        if low and i < final and "�" not in low and not low.isdigit() and any(ch.isalpha() for ch in low):
            if _parted(t, spans[i + 1][2] if i + 1 < len(spans) else "", m) and i + 1 < final:
                found.append("spaced")
                fresh, skip = t + spans[i + 1][2], i + 1
            elif not (m.known(low) or m.known(low.rstrip("!"))) and len(low) >= 2:
                near = [x for _, _, x in spans[max(0, i - WINDOW) : i] + spans[i + 1 : i + 1 + WINDOW]]
                good = m.fix(c, near) or m.fix(c.rstrip("!"), near)
                if good is None and "-" in low:
                    parts = [p if m.known(p) else m.fix(p, near) for p in low.split("-")]
                    good = "-".join(parts) if all(parts) else None
                if good and good != low:
                    found.append("misread")
                    fresh = t.replace(c, _cased(good, c))
        if fresh is not None:
            out.append(text[at:s] + fresh)
            at = spans[max(skip, i)][1]
    text = "".join(out) + text[at:]
    paragraphs = [" ".join(p.split()) for p in re.split(r"\n[ \t]*\n+", text)]
    return "\n\n".join(p for p in paragraphs if p), found


def _side_by_side(left: str, right: str) -> str:
    """Two tokens as one word if nothing but the space parts them, else ''."""
    if not left or not right or left[-1] in _PUNCT or right[0] in _PUNCT:
        return ""
    a, b = core(left).lower(), core(right).lower()
    return a + b if a.isalpha() and b.isalpha() and len(a) + len(b) >= 5 else ""


def _parted(left: str, right: str, m: Model) -> bool:
    joined = _side_by_side(left, right)
    a, b = core(left).lower(), core(right).lower()
    if not joined or (a in m.good and b in m.good) or not m.known(joined):
        return False
    return m.count(joined) * PARTED * m.total > m.count(a) * m.count(b)


def repair(text: str, m: Model, may_be_cut: bool = True) -> tuple[str, list[str]]:
    """Continuous text in paragraphs, and the kinds of scan noise it held. The
    last word of a text that may be cut off is not judged if no full stop follows."""
    text = plain(text).replace("\r\n", "\n").replace("\r", "\n")
    cut_off = may_be_cut and not _END.search(text)
    text, furniture = strip_furniture(text, m)
    text, numbers = _strip_numbers(text, m)
    text, found = mend(text, m, cut_off)
    return text, sorted(set(found + ["furniture"] * (furniture or numbers)))


# ---- what a text asks ----
def asks(text: str, m: Model) -> tuple[set[str], set[str], set[tuple[str, str]]]:
    """Rare words, heads and pairs whose counts the repair of a text may need, more rather than fewer."""
    text = plain(text).replace("\r\n", "\n").replace("\r", "\n")
    heads = {h for h in _heads_in(text) if h not in m.heads}
    lines = _LINE.split(text)
    bodies = [strip_furniture(text, m)[0]]
    if heads:
        bodies.append(strip_furniture("\n".join(x for x in lines if head_of(x) not in heads), m)[0])
    words: set[str] = set()
    pairs: set[tuple[str, str]] = set()
    for body in bodies:
        _ask_words(body, words, m)
        numbers = [x for x in _BARE.finditer(body) if _may_be_page(x, m)]
        for x in numbers:
            a, b = core(_token_before(body, x.start())).lower(), core(x[1]).lower()
            pairs |= {(a, b), (a, "#"), ("#", b)}
        if numbers:  # a number taken out joins its neighbours
            _ask_words(_BARE.sub(lambda x: " " if _may_be_page(x, m) else x[0], body), words, m)
    rare = {w for w in words if w and w not in m.words and any(c.isalpha() for c in w)}
    return rare, heads, {p for p in pairs if p not in m.pairs}


def _may_be_page(x: re.Match, m: Model) -> bool:
    """Whether a number may be a page's, as far as the counts of frequent pairs tell."""
    before = _token_before(x.string, x.start())
    if not before or before[-1] in ".,;:":
        return False
    a, b = core(before).lower(), core(x[1]).lower()
    # A pair with the number that is known, or more frequent than one that is not, rules it out.
    n = m.pairs.get((a, b), m.least)
    return RARER * m.pairs.get((a, "#"), 0) < n and RARER * m.pairs.get(("#", b), 0) < n


def _ask_words(text: str, words: set[str], m: Model) -> None:
    def word(w: str) -> None:
        w = core(w).lower()
        words.update((w, w.rstrip("!")))
        if "-" in w:
            words.update(w.split("-"))

    broken = text
    for _ in range(3):
        for x in _breaks(broken):
            left, right = (x[1], x[4]) if x[1] is not None else (x[5], x[6])
            a, b = core(left).lower(), core(right).lower()
            for w in (left + right, f"{a}-{b}", a.rsplit("-", 1)[-1] + right, left + core(right).split("-", 1)[0], a, b):
                word(w)
        again = _join_breaks(broken, lambda x: (x[1] + x[4]) if x[1] is not None else (x[5] + x[6]))
        if again == broken:
            break
        broken = again
    for body in {text, broken}:
        toks = body.split()
        for x in _SPACED.finditer(body) if _letters_apart(toks) else ():
            bits = x[0].split(" ")
            for lo, hi in ((0, len(bits)), (0, len(bits) - 1), (1, len(bits))):
                word("".join(bits[lo:hi]))
        for i, t in enumerate(toks):
            if m.kind(t) & WORD:
                word(t)
                for left, right in (toks[i - 1 : i + 1] if i else ["", ""], toks[i : i + 2] if i + 1 < len(toks) else ["", ""]):
                    words.add(_side_by_side(left, right))


def _numbers_clear(text: str, m: Model, kind: int) -> bool:
    """Whether no number in the text can be furniture: a quick look that never says so wrongly."""
    if "\n" in text or "\f" in text:
        if any(_NUMBER_LINE.match(x) or head_of(x) for x in _LINE.split(text)):
            return False
    if kind & PAGE and _INLINE.search(text):
        return False
    if any(_may_be_page(x, m) for x in _BARE.finditer(text)):
        return False
    return not kind & HEAD or _inline_heads(text, m) == text


class Look:
    """Tells in one pass over its tokens whether a text needs more than a look."""

    def __init__(self, m: Model):
        self.m, self.clear = m, set()

    def needs_more(self, text: str) -> bool:
        rest = set(text.split()) - self.clear
        if not rest:
            return False
        kind, letters = 0, 0
        for t in rest:
            k = self.m.kind(t)
            if k == CLEAR:
                if len(self.clear) > FLUSH:
                    self.clear.clear()
                self.clear.add(t)
            elif k & LETTER:
                # A letter by itself is a word to look at only in a row of them.
                letters += 1
            else:
                kind |= k
        if kind & WORD or letters > 1 and _SPACED.search(text) or kind & HALF and not all(_is_suspended(x, self.m) for x in _breaks(text)):
            return True
        return bool(kind & DIGIT) and not _numbers_clear(text, self.m, kind)


# ---- over a table ----
def _long(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields])).alias("p")
    return df.select(key, pairs).select(key, "p.field_name", "p.value").filter("value is not null and value <> ''")


def _texts(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Each distinct value of a field once, kept, with a hash to find it by."""
    return keep(_long(df, key, fields).select("field_name", "value").distinct().withColumn("h", F.md5("value")))


def _arrow(spec: str):
    out = T._parse_datatype_string(spec)
    return out, arrow_schema(out)


def _normal(value: str) -> str:
    return plain(value).replace("\r\n", "\n").replace("\r", "\n")


def _counts(texts: DataFrame) -> DataFrame:
    """``kind, key, n``: words (w), pairs (p, joined by a tab) and line templates (h); a text votes once for a template."""
    out, schema = _arrow("kind string, key string, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, beside, heads, seen = Counter(), Counter(), Counter(), {}

        def told() -> pa.RecordBatch:
            rows: dict[tuple[str, str], int] = Counter()
            of = lambda t: seen.get(t) or seen.setdefault(t, word_of(t))
            for t, n in raw.items():
                if w := of(t):
                    rows["w", w] += n
            for (a, b), n in beside.items():
                if (a := of(a)) and (b := of(b)):
                    rows["p", a + _SEP + b] += n
            for h, n in heads.items():
                rows["h", h] += n
            got = [(k, w, n) for (k, w), n in rows.items() if n > 0]
            for c in (raw, beside, heads, seen):
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*got) if got else ((), (), ()), schema.types)], schema=schema)

        for b in batches:
            for v in b.column(0).to_pylist():
                text = _normal(v)
                toks = text.split()
                raw.update(toks)
                beside.update(zip(toks, toks[1:]))
                # Halves of broken words are no words.
                if "- " in text or "-\n" in text or "¬" in text:
                    for x in _HALVES.finditer(text):
                        raw[x[1]] -= 1
                        if x[2][-1] not in "-¬":
                            raw[x[2]] -= 1
                if "\n" in text:
                    heads.update(set(_heads_in(text)))
            if len(raw) + len(beside) > FLUSH:
                yield told()
        yield told()

    return keep(texts.select("value").mapInArrow(count, out).groupBy("kind", "key").agg(F.sum("n").alias("n")))


def _context_counts(texts: DataFrame, words: list[str], n_contexts: int) -> np.ndarray:
    """How often each frequent word has each context, the first ``n_contexts`` of them, within WINDOW places."""
    out, schema = _arrow("at long, n long")
    width, cells = n_contexts, len(words) * n_contexts
    shared = texts.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seen, total = shared.value, {}, np.zeros(cells, dtype=np.int64)
        for b in batches:
            line: list[int] = []
            for v in b.column(0).to_pylist():
                for t in _normal(v).split():
                    i = seen.get(t)
                    if i is None:
                        if len(seen) > FLUSH:
                            seen.clear()
                        i = seen[t] = ids.get(word_of(t), -1)
                    line.append(i)
                line += [-1] * WINDOW
            a = np.array(line, dtype=np.int64)
            for k in range(1, WINDOW + 1):
                for x, y in ((a[:-k], a[k:]), (a[k:], a[:-k])):
                    ok = (x >= 0) & (y >= 0) & (y < width)
                    total += np.bincount(x[ok] * width + y[ok], minlength=cells)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], schema=schema)

    table = np.zeros(cells)
    # At most (1 / HOT_SHARE) x (1 / CONTEXT_SHARE) cells, whatever the corpus.
    got = texts.select("value").mapInArrow(count, out).groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    table[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return table.reshape(len(words), n_contexts)


def _vectors(counts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of words, and of contexts with frequent ones weighted down.

    The optimum of skip-gram with negative sampling factorises the pointwise
    information of word and context, contexts smoothed by the power 3/4.
    """
    smooth = counts.sum(axis=0) ** 0.75
    expected = counts.sum(axis=1, keepdims=True) * (smooth / max(smooth.sum(), 1.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        info = np.where(counts > 0, np.maximum(np.log(counts / expected), 0.0), 0.0)
    _, turn = np.linalg.eigh(info.T @ info)
    turn = turn[:, ::-1][:, :DIM]
    turn = np.pad(turn, ((0, 0), (0, DIM - turn.shape[1])))
    words = info @ turn
    words /= np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-9)
    return words.astype(np.float32), (turn * (HALF_WEIGHT / (HALF_WEIGHT + shares))[:, None]).astype(np.float32)


def learn(df: DataFrame, fields: Sequence[str], key: str = "id") -> Model:
    """The model of the frequent words of all values."""
    texts = _texts(df, key, fields)
    return _model(texts, _counts(texts))


def _model(texts: DataFrame, counts: DataFrame) -> Model:
    size = {r["kind"]: r["n"] for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    total, n_texts = size.get("w", 0), texts.count()
    hot = lambda kind, least: counts.filter((F.col("kind") == kind) & (F.col("n") >= least)).select("key", "n").toArrow().to_pylist()
    # Each is bounded by a relative frequency; see HOT_SHARE.
    words = sorted(hot("w", max(LEAST, HOT_SHARE * total)), key=lambda r: (-r["n"], r["key"]))
    pairs = hot("p", max(LEAST, HOT_SHARE * total))
    heads = hot("h", max(HEAD_LEAST, HOT_SHARE * n_texts))
    names = [r["key"] for r in words]
    n_contexts = sum(r["n"] >= CONTEXT_SHARE * total for r in words)
    vectors, contexts = {}, {}
    if n_contexts:
        v, c = _vectors(_context_counts(texts, names, n_contexts), np.array([r["n"] / total for r in words[:n_contexts]]))
        vectors, contexts = dict(zip(names, v)), dict(zip(names, c))
    return Model(total, {r["key"]: r["n"] for r in words}, {tuple(r["key"].split(_SEP)): r["n"] for r in pairs}, {r["key"] for r in heads}, vectors, contexts, max(LEAST, HOT_SHARE * total))


def _parts(m: Model):
    return m.total, m.words, m.pairs, m.heads, m.vectors, m.contexts, m.least


def _worth_more(texts: DataFrame, shared) -> DataFrame:
    """The texts that need more than a look, with what they ask of rare words (w), heads (h) and pairs (p)."""
    out, schema = _arrow("h string, field_name string, value string, asks array<struct<kind:string,key:string>>")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        see = Look(m)
        for b in batches:
            rows = []
            for h, f, v in zip(*(b.column(i).to_pylist() for i in range(3))):
                text = _normal(v)
                if see.needs_more(text):
                    words, heads, pairs = asks(text, m)
                    said = [("w", w) for w in words] + [("h", x) for x in heads] + [("p", a + _SEP + c) for a, c in pairs]
                    rows.append({"h": h, "field_name": f, "value": text, "asks": [{"kind": k, "key": x} for k, x in said]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return keep(texts.select("h", "field_name", "value").mapInArrow(look, out))


def _shaped(words: DataFrame) -> DataFrame:
    """``key, n, shape`` for every shape of each word."""
    out, schema = _arrow("key string, n long, shape string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{"key": w, "n": n, "shape": s} for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for s in shapes(w)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return words.select("key", "n").mapInArrow(work, out)


def _rare_vectors(slow: DataFrame, shared) -> DataFrame:
    """``key, v``: the mean of the contexts of each word too rare for a vector of its own.

    Such a word makes its text worth more than a look, so these texts hold all its uses.
    """
    names = [f"v{i}" for i in range(DIM)]
    out, schema = _arrow("key string, " + ", ".join(f"{v} double" for v in names))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, words, _, _, _, contexts, _ = shared.value
        sums: dict[str, np.ndarray] = {}
        told = lambda: pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), *(pa.array([float(v[i]) for v in sums.values()], pa.float64()) for i in range(DIM))], schema=schema)
        for b in batches:
            for text in b.column(0).to_pylist():
                toks = [word_of(t) for t in text.split()]
                for i, w in enumerate(toks):
                    if w and w not in words:
                        near = [contexts[x] for x in toks[max(0, i - WINDOW) : i] + toks[i + 1 : i + 1 + WINDOW] if x in contexts]
                        if near:
                            sums[w] = sums.get(w, 0.0) + np.sum(near, axis=0)
            if len(sums) > FLUSH // DIM:
                yield told()
                sums.clear()
        yield told()

    summed = slow.select("value").mapInArrow(work, out).groupBy("key").agg(*[F.sum(v).alias(v) for v in names])
    return summed.select("key", F.array(*[F.col(v).cast("float") for v in names]).alias("v"))


def _answers(slow: DataFrame, counts: DataFrame, m: Model, shared) -> DataFrame:
    """``h, field_name, told``: each text's asked words, heads and pairs with their counts, and the rare words of the shape of each word."""
    asked = slow.select("h", "field_name", F.explode("asks").alias("a")).select("h", "field_name", "a.*")
    known = asked.select("kind", "key").distinct().join(counts, ["kind", "key"], "left").select("kind", "key", F.coalesce("n", F.lit(0)).alias("n"))
    known = keep(known)
    rare = counts.filter((F.col("kind") == "w") & (F.col("n") >= LEAST) & (F.col("n") < m.least))
    mates = _shaped(known.filter("kind = 'w'")).join(_shaped(rare).select(F.col("key").alias("c"), F.col("n").alias("m"), "shape"), "shape").filter((F.col("c") != F.col("key")) & (F.col("m") > RARER * F.col("n")))
    mates = mates.select("key", "c", "m").distinct().join(_rare_vectors(slow, shared).select(F.col("key").alias("c"), "v"), "c", "left")
    mates = mates.groupBy("key").agg(F.collect_list(F.struct("c", "m", "v")).alias("mates"))  # the words of one shape
    answered = known.join(mates.withColumn("kind", F.lit("w")), ["kind", "key"], "left").filter("n > 0 or mates is not null")
    return asked.join(answered, ["kind", "key"]).groupBy("h", "field_name").agg(F.collect_list(F.struct("kind", "key", "n", "mates")).alias("told"))  # what one text asked


def _tell(m: Model, told: list[dict] | None) -> None:
    told = told or []
    m.asked_words = {x["key"]: x["n"] for x in told if x["kind"] == "w" and x["n"]}
    m.asked_mates = {x["key"]: [(y["c"], y["m"], _unit(np.array(y["v"], dtype=np.float32)) if y["v"] else None) for y in x["mates"]] for x in told if x["mates"]}
    m.asked_pairs = {tuple(x["key"].split(_SEP)): x["n"] for x in told if x["kind"] == "p"}
    m.asked_heads = {x["key"] for x in told if x["kind"] == "h" and x["n"] >= HEAD_LEAST}


def repair_fields(df: DataFrame, key: str, fields: Sequence[str], may_be_cut: Sequence[str] = ("abstract",)) -> DataFrame:
    """``key, field_name, kinds, repaired`` of every value that held scan noise.

    Values without noise, null and empty ones give no row; repeated rows are
    kept and judged alike, a text teaching once however often it is copied.
    Very long texts are worked on whole. An empty table gives an empty result.
    """
    texts = _texts(df, key, fields)
    counts = _counts(texts)
    m = _model(texts, counts)
    shared = df.sparkSession.sparkContext.broadcast(_parts(m))
    slow = _worth_more(texts, shared)
    asked = slow.join(_answers(slow, counts, m, shared), ["h", "field_name"], "left")
    out, schema = _arrow("h string, field_name string, kinds array<string>, repaired string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for b in batches:
            rows = []
            for h, f, v, told in zip(*(b.column(i).to_pylist() for i in range(4))):
                _tell(m, told)
                text, kinds = repair(v, m, f in may_be_cut)
                if kinds:
                    rows.append({"h": h, "field_name": f, "kinds": kinds, "repaired": text})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    fixed = asked.select("h", "field_name", "value", "told").mapInArrow(work, out)
    owners = _long(df, key, fields).select(key, "field_name", F.md5("value").alias("h"))
    return owners.join(fixed, ["field_name", "h"]).select(key, "field_name", "kinds", "repaired")
