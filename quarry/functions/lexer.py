"""Tokens and sentence ends of running text in English, German and Russian.

A scanner in the manner of generated lexers: at each place all rules of the
state are tried, the longest match wins (what a rule only looks at counts
towards its length) and among equals the earlier rule. Spans that a date, an
abbreviation or a short remark in brackets covers hold no sentence end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from quarry.functions.abbreviations import BEGINNERS_DE, BEGINNERS_EN, Automaton, automaton

# Months.
MONTHS_EN = "January February March April May June July August September October November December Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec".split()
MONTHS_DE = "Januar Jänner Februar Feber März April Mai Juni Juli August September Oktober November Dezember Jan Feb Apr Jun Jul Aug Sep Sept Okt Nov Dez".split()
MONTHS_RU = "января февраля марта апреля мая июня июля августа сентября октября ноября декабря янв фев апр авг сент окт нояб дек".split()

# Words that keep the hyphen at a line's end, as first or as last part.
HYPHEN_FIRST_EN = "self one high non well half three low anti two twenty long four re co double forty out thirty ever pre".split()
HYPHEN_LAST_EN = "up class time year century day five hour run wide haired hand one out two four level long made old six state three war action conscious dimensional down eyed fifth fold foot grade in inch law loving man minded nine owned".split()

SPACE = r"[ \t\xa0\n\x0b\x0c\r]"
CLOSING, OPENING = r"['\")\]}>«»‹›“”‘’]", r"[(\[{<\"'`»«›‹„‚“”‘’¡¿]"
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
TYPES = ("HSPACE", "VSPACE", "NEWLINE", "WORD", "NUMBER", "OTHER", "EOS", "DATE", "COMPLEX", "ABBR", "WWW")


def _any(words) -> str:
    return "|".join(map(re.escape, sorted(words, key=len, reverse=True)))


class Mailed:
    """A rule for mail addresses that looks once at each run of their characters. Has the interface of a compiled pattern."""

    groupindex: dict[str, int] = {}

    def __init__(self, host: str):
        self.run, self.host = re.compile(r"[A-Za-z0-9_.:-]+"), re.compile(host)
        self.whole = re.compile(rf"(?:mailto:)?[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)*@{host}")
        self.text, self.start, self.stop, self.possible = "", 0, -1, False

    def match(self, text: str, at: int) -> re.Match | None:
        if text is not self.text or not self.start <= at < self.stop:
            m = self.run.match(text, at)
            self.text, self.start, self.stop = text, at, m.end() if m else at
            self.possible = text.startswith("@", self.stop) and bool(self.host.match(text, self.stop + 1))
        return self.whole.match(text, at) if self.possible else None


class Pointed:
    """A rule for what stands before a point: the longest of the entries of an automaton and of what a pattern finds. `behind` is the
    point and what follows it; its group `ahead`, if it has one, is only looked at. Has the interface of a compiled pattern."""

    def __init__(self, known: Automaton, pattern: str, behind: str):
        self.known, self.pattern, self.behind = known, re.compile(pattern), re.compile(behind)
        self.groupindex = self.behind.groupindex

    def match(self, text: str, at: int) -> Match | None:
        m = self.pattern.match(text, at)
        ends = {self.known.end(text, at), m.end() if m else -1} - {-1}
        for end in sorted(ends, reverse=True):
            if found := self.behind.match(text, end):
                return Match(end + 1, found.end("ahead") if self.groupindex else end + 1)
        return None


@dataclass
class Match:
    """Where a match ends, and where what it looks at ends."""

    stop: int
    ahead: int

    def end(self, group: str | int = 0) -> int:
        return self.ahead if group == "ahead" else self.stop


@dataclass
class Lexer:
    """`hyphens`: None, "drop" or "keep" the hyphens of words that a line end parts; English words that always
    have one keep it. `more` adds abbreviations."""

    language: str = "en"
    sentence_ends: bool = True
    addresses: bool = True
    hyphens: str | None = None
    more: tuple[str, ...] = ()
    rules: list[tuple[str, re.Pattern]] = field(init=False)

    def __post_init__(self):
        letter = LATIN + "Ѐ-ӿ" if self.language == "ru" else LATIN
        upper = "A-ZÀ-ÖØ-ÞЀ-Я" if self.language == "ru" else "A-ZÀ-ÖØ-Þ"
        lower = "a-zß-öø-ÿа-я" if self.language == "ru" else "a-zß-öø-ÿ"
        months, beginners = {"en": (MONTHS_EN, BEGINNERS_EN), "de": (MONTHS_DE, BEGINNERS_DE), "ru": (MONTHS_RU, [])}[self.language]
        known = automaton(self.language, self.more, letter, SPACE)
        word = rf"[{letter}]+(?:-[{letter}]+)*"
        if self.language == "ru":
            word = rf"(?:\d+-)?{word}"
        mark = rf"{OPENING}*[{upper}0-9]"
        day = r"(?:3[01]|[012]?[0-9]|1st|2nd|3rd|[0-9]{1,2}th)"
        month = rf"(?:(?:{_any(months)})\.?|(?:x?i{{1,3}}|i?x|x?i?v|vi{{1,3}}|X?I{{1,3}}|I?X|X?I?V|VI{{1,3}})(?:\.|{SPACE}))"
        year = rf"(?:[1-9][0-9]{{0,3}}|0[0-9])(?:{SPACE}*[AB]\.{SPACE}*[CDP]\.{SPACE}*(?:E\.{SPACE}*)?)?"
        initials = rf"(?:(?:[{letter}]|[{upper}][{lower}])\.{SPACE}*)+[{letter}][{lower}]?"
        single = rf"[{upper}]|{word}-?[Ss]tr" + (r"|\d{1,4}|[IVXLC]+" if self.language == "de" else "")
        host = r"[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+"
        www = rf"(?:(?:https?|ftps?|file|news)://|www\.){host}(?:/[^ \t\n-\r\x00-\x1f]+[A-Za-z0-9_/-])?"
        hyphen = rf"[-\xad][ \t\xa0]*[\n\x0c\r][ \t\xa0]*"
        rules: list[tuple[str, str | Pointed | Mailed]] = []
        self.broken = re.compile(rf"{word}(?:(?:\xad(?=[{letter}])|{hyphen}(?=[{lower}])){word})+")
        self.cut = re.compile(rf"({hyphen}|\xad)")
        first, last = (HYPHEN_FIRST_EN, HYPHEN_LAST_EN) if self.language == "en" else ((), ())
        self.first, self.last = set(first), set(last)
        if self.addresses:
            rules += [("WWW", www), ("WWW", Mailed(host))]
        if self.sentence_ends:
            rules += [("hold", rf"(?:{word}|\d+){SPACE}+\([^.!?]{{1,40}}[.!?][^\n]{{0,40}}?\)"), ("hold", rf"(?:{day}(?:\.{SPACE}*|{SPACE}*){month}{SPACE}*{year}|{month}{SPACE}*{day},?{SPACE}*{year}|{day}\.{SPACE}*{month})"), ("hold", Pointed(known, rf"(?:{initials}|{single})(?=\.)", rf"\.(?![{letter}])"))]
            rules.append(("end", rf"[.!?]+(?={CLOSING}*{SPACE}+{mark})"))
            if beginners:
                rules.append(("begins", Pointed(known, rf"{initials}(?=\.)", rf"\.(?P<ahead>{CLOSING}*{SPACE}+{OPENING}*(?:(?:{_any(beginners)})(?:{SPACE}|,)|(?:A|I|The){SPACE}[a-z]))")))
        rules += [("WORD", word), ("NUMBER", r"\d+(?:[,.]\d+)?"), ("VSPACE", rf"[ \t\xa0]*[\n-\r]+{SPACE}*"), ("HSPACE", r"[ \t\xa0]+"), ("", r"[\x00-\x1f]+"), ("OTHER", r"(?s).")]
        look = re.compile(r"\(\?=(.*)\)$", re.S)
        self.rules = []
        for name, pattern in rules:
            if not isinstance(pattern, str):
                self.rules.append((name, pattern))
                continue
            ahead = look.search(pattern) if name == "end" else None
            # What a rule looks at counts towards its length: it is a group of its own.
            self.rules.append((name, re.compile(pattern[: ahead.start()] + f"(?=(?P<ahead>{ahead.group(1)}))" if ahead else pattern)))
        # Signs that no word, number, address or abbreviation begins with: they stand for themselves, but for blanks before other blanks and for ends of sentences.
        begun = set(known.tree)
        self.others = set() if "" in begun else set(",;:\"'()[]«»„“”‘’–—…") - begun
        self.stops = set() if "" in begun else set(".!?") - begun
        self.blank = re.compile(r"[ \xa0]++(?![\t-\r])") if not begun & {"", " ", "\xa0"} else re.compile(r"(?!)")
        self.ending = [(n, p) for n, p in self.rules if n in ("end", "OTHER")]
        self.word = re.compile(word)
        self.plain = re.compile(rf"[ \t\xa0,;](?![ \t\xa0\n-\r]*[(\d])")
        self.roman = re.compile(r"[xviXVI]+\Z")
        self.months = set(months)
        # Such words in a row, each with one blank, are one match. All that begins one is a letter to Python.
        plain = rf"[{letter}]++(?:-[{letter}]++)*+"
        self.run = re.compile(rf"(?:(?=[{LATIN}Ѐ-ҁҊ-ӿ])(?!(?:{_any(months)}|[xviXVI]+)[ ,;]){plain}[,;]? (?=[{letter}])){{1,500}}+" if self.language == "ru" else rf"(?:(?!(?:{_any(months)}|[xviXVI]+)[ ,;]){plain}[,;]? (?=[{letter}])){{1,500}}+")
        self.pieces, self.words = re.compile(r"[^ ,;]+|[ ,;]"), re.compile(r"[,;]? ")
        # Without sentences and addresses the first sign tells the rule, but for blanks before other blanks and controls.
        self.single = None if self.sentence_ends or self.addresses else re.compile(rf"(?s)(?P<WORD>{word})|(?P<NUMBER>\d+(?:[,.]\d+)?)|(?P<HSPACE>[ \xa0]++(?![\t-\r]))|(?P<OTHER>[^\x00-\x20\xa0])")
        self.held = [(n, p) for n, p in self.rules if n in ("WORD", "VSPACE", "HSPACE", "OTHER")]
        self.held.insert(1, ("NUMBER", re.compile(r"\d+")))

    def _longest(self, text: str, at: int, rules) -> tuple[str, int]:
        best, name, end = -1, "OTHER", at + 1
        if self.single and (m := self.single.match(text, at)):
            return m.lastgroup, m.end()
        if rules is self.rules:
            if text[at] in self.others:
                return "OTHER", at + 1
            if m := self.blank.match(text, at):
                return "HSPACE", m.end()
            if text[at] in self.stops:
                rules = self.ending
        if rules is self.rules and text[at].isalpha():
            # A word before a blank or comma is only a word, unless a date or a bracket may follow.
            m = self.word.match(text, at)
            if m and self.plain.match(text, m.end()) and m.group() not in self.months and not self.roman.match(m.group()):
                return "WORD", m.end()
        for n, p in rules:
            m = p.match(text, at)
            if m:
                size = (m.end("ahead") if "ahead" in p.groupindex else m.end()) - at
                if size > best:
                    best, name, end = size, n, m.end()
        return name, end

    def _joined(self, m: re.Match) -> str:
        """The parts of a word without the line ends, and without hyphens unless they are kept."""
        parts = self.cut.split(m.group())
        out = parts[0]
        for before, cut, part in zip(parts[::2], parts[1::2], parts[2::2]):
            kept = len(cut) > 1 and (self.hyphens == "keep" or before.lower() in self.first or part.lower() in self.last)
            out += ("-" if kept else "") + part
        return out

    def parts(self, text: str) -> Iterator[tuple[str, str]]:
        """As `tokens`, but words in a row with a blank, or a comma or semicolon and a blank, behind each are one part, a RUN."""
        if self.hyphens:
            text = self.broken.sub(self._joined, text)
        at, hold = 0, -1
        while at < len(text):
            if at < hold:
                name, end = self._longest(text, at, self.held)
                yield name, text[at:end]
                at = end
                continue
            if m := self.run.match(text, at):
                yield "RUN", m.group()
                at = m.end()
                continue
            name, end = self._longest(text, at, self.rules)
            if name == "hold":
                hold = end
                continue
            if name == "begins":
                hold = end - 1
                continue
            if name == "end":
                while at < len(text) and (at < end or re.match(CLOSING, text[at])):
                    yield "OTHER", text[at]
                    at += 1
                yield "EOS", ""
                continue
            if name == "HSPACE" and (at == 0 or text[at - 1] in "\n\x0c\r"):
                name = ""
            if name:
                yield name, text[at:end]
            at = end

    def tokens(self, text: str) -> list[tuple[str, str]]:
        """(type, text) in order; a sentence end is an EOS token without text."""
        out: list[tuple[str, str]] = []
        for name, part in self.parts(text):
            if name == "RUN":
                out += [("HSPACE" if x == " " else "OTHER" if x in ",;" else "WORD", x) for x in self.pieces.findall(part)]
            else:
                out.append((name, part))
        return out

    def counts(self, text: str) -> tuple[dict[str, int], int]:
        """How many tokens of each type `tokens` gives, and the length of the longest word. Takes no list of them."""
        out, longest = dict.fromkeys(TYPES, 0), 0
        for name, part in self.parts(text):
            if name == "RUN":
                blanks, others = part.count(" "), part.count(",") + part.count(";")
                out["WORD"] += blanks
                out["HSPACE"] += blanks
                out["OTHER"] += others
                longest = max(longest, max(map(len, self.words.split(part))))
            else:
                out[name] += 1
                if name == "WORD":
                    longest = max(longest, len(part))
        return out, longest

    def sentences(self, text: str) -> list[str]:
        """Sentences of a text: line ends end one too, but for a number or letter with a point that stands alone."""
        lines, line = [], ""
        for name, part in self.parts(text):
            if name in ("EOS", "VSPACE"):
                if line:
                    lines.append(line)
                line = ""
            else:
                line += " " if name == "HSPACE" else part
        lines.append(line)
        joined = re.sub(r"(?m)^(\d+\.|\w\.)[ \t]*\n", r"\1 ", "\n".join(x.strip() for x in lines))
        return [s for s in re.split(r"\n+", joined) if s.strip()]
