"""Abbreviations of three languages as one prefix automaton each.

An entry is a sequence of parts, each with a point behind it: `Dr`, `Ph D`, `i d R`; blanks may stand
between point and next part. Entries are words, combinations of parts that a rule makes, and what
a table of one's own adds. At a place of a text one walk over the automaton finds the
longest entry, however many there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import product

# Words that mostly begin a sentence.
BEGINNERS_EN = "About After All Although Among An And Another As At Because Before Both But By Do Don't During Each Even Every Finally For From He Her Here His How However I'll I'm If In Is It It's Its Just Let Like Many Maybe More Moreover Most My No Not Now Of On Once One Only Or Other Our Perhaps She Since So Some Sometimes Such That That's Their Then There These They This Those Though Thus To Two Under We Well What When Where While Why With Yet You".split()
BEGINNERS_DE = "Ab Als Am An Anhand Ans Auf Aufs Aus Außer Bei Beim Bis Damit Das Dass Daß Dem Den Denn Der Deren Des Die Dies Diese Diesem Diesen Dieser Dieses Durch Durchs Entweder Es Für Gegen Hier Hinter In Ins Je Jene Jenem Jenen Jener Jenes Mit Nach Neben Ob Obwohl Oder Ohne Seit Sowohl Statt Um Und Vom Von Vor Wegen Weil Welche Welchem Welchen Welcher Welches Zum Zur Über À".split()

# Abbreviations with a vowel, by kind; words of consonants alone go by a rule.
TITLES_EN = "Adj Adm Adms Assoc Bart Brig Capt Capts Col Cols col Comm Comms Emer Gen Gens gen Gov Govs gov Hon Ing Maj Majs maj Pres Prof prof Rep Reps rep reps Rev Revs rev Sec Secs sec Sen Sens sen sens Supt Messrs messrs".split()
PAPERS_EN = "p al app approx biblio bibl cap cent chap ed Ed eds Eds encyc eq eqn eqns Est est et etc Ex fam fig figs Fig Figs Fol Ibid ibid illus incl introd lang loc nos no No Nos Op op par poss pref prelim prob prop pub publ quant ref Ref rel repr res resp rev seq spec subj supp suppl sup trans Univ univ var viz vol vols Vol Vols".split()
PLACES_EN = "Ala Ariz Assn Ave Beds Berks Blvd Bldg Bros Bucks Cal Calif Co Colo Conn Corp Dak Del Dept dept Dist dist Fla Hants Herts Ida Ill Inc Ind inst Inst Kans Mass Mich Minn Miss Mo Mont Neb Nev Notts Okla Ont Ore Oxon Pa Penna Que Sask Staffs Tex Va Wash Wilts Wis Wyo".split()
MEASURES_EN = "adv acc anon biol bot ca deg dia fahr gal geog geol geom govt gram hist lat lit log max med mil min misc mo mos naut obs oz pop psychol temp theol zool".split()
TITLES_DE = "Abg Dipl Doz Dir Frau Ing Insp Mag Präs Prof Red Univ theol phil jur med rer nat pol cand stud".split()
WORDS_DE = "Abb Abk Abs Abt abzgl allg allgem amer amerikan amtl Anh Ank Anl Anm anschl App arab Art Aufl Az Bde beil bes Bes Betr betr bez Bez bosn brit bulgar ca Chr dän ebd Ed ed ehem eidg eigtl einschl engl entspr erb estn etc ev evtl exkl Expl Fa Fam Fig fig finn folg Forts franz geb Geb Gebr gegr gek gem ges Ges gesch gest Gew gez griech Hann hebr hins holl holländ Inc incl Inf Inh inkl insb insbes isländ ital Jahrh jur Kap kath kaufm kroat Kto lat Lit lit luth max mech mdl Mill min Min Mio Mitw möbl mod näml norweg Obb od offiz orig orth österr pers poln portug Präs Reg resp röm russ schwed sen serb slow sog span spez Std stellv Stück Tel tel tsch türk U ua ugs ung urspr usw usf verh verst vers versch vollst Vol vorm wiss zahlr Ztr zool zus Zus".split()
PARTS_DE = "a d, a o, a a O, Bes Gr, d h, d i, e h, e V, h c, i A, i allg, i b, i D, i d, i d R, i V, m E, m W, n Chr, v Chr, o ä, o d, o g, p A, p Adr, s o, s u, u a, u ä, u U, u Z, usw u, v a, z B, z T, z Zt, Dr jur, Dr Jur, Dr med, Dr phil, Dr rer nat, Dr theol".split(", ")
WORDS_RU = "авт акад амер анат англ ант арх бул бывш быв вводн вел вин возвр вступ где гор гос греч губ дат дол долл евр ед жел жен зав зам зап знач изд илл им инж ирл искаж исп ист итал канд кап каф книжн комм коммент коп ласк лат лев лимф лит мед мес мест мил мин моск муж муз наб наз напр нар наст науч нач неопр нем несов обл обр однокр ок оп опубл отд отеч оч пер первонач печ пог подг полн пор порядк пос посл пост поч правосл пред предл прил прим примеч прод прост проф проч разг ред рег рец рис род роман руб рус русск сем сев сек син соавт собр сов совм совр сокр соотв соч союзн спец средневек стар сущ табл тел тов указ ул ум уменьш унич употр устар уч учен физ филол франц хим худ худож цит чел швейц шест шотл экз эл".split()
PARTS_RU = "т е, т к, т н, т п, т д, т ч, и о, н э, до н э, н ст, с г, м б, в н э, г г, Ф И О, И Д К, Р Х, полн собр, собр соч, гл обр, млн руб, млрд руб, тыс руб, см прим".split(", ")

# Subjects of English degrees, behind B, M or D; and what follows the first part of other titles.
DEGREES_EN = "A Arch Arts Ch Chem Com Comm Comp Crim Des Div Ec Econ Ed Eng Env Lang Lit Litt Math Med Min Mus Pharm Phil Psych Rec Sc Tech Theol Univ".split()
TITLED_EN = "Ph D, Ed D, Eng D, Psy D, Pharm D, Th D, Sc D, Litt D, Rh D, Rt Hon, Maj -Gen, Lt -Col, Lt -Gen, Brig Gen, Adj Prof, Assoc Prof, Emer Prof, Reg Prof, Dr med, Dr phil, Dr theol, Lat Am, Soc Sci, pol sci, quant suff, sq ft, cu ft, pro tem".split(", ")

VOWELS = "aeiouyäöüáàâéèêíìîóòôúùûаеёиоуыэюя"
#: Words of two to so many letters count as abbreviations if they are consonants alone, the first of them in either case.
MOST_CONSONANTS = 5


def entries(language: str) -> list[str]:
    """The abbreviations of a language; each word also with a capital."""
    if language == "en":
        degrees = [f"{a} {b}" for a, b in product("BMD", DEGREES_EN)]
        return [*TITLES_EN, *PAPERS_EN, *PLACES_EN, *MEASURES_EN, *degrees, *TITLED_EN]
    words, parts = (WORDS_DE + TITLES_DE, PARTS_DE) if language == "de" else (WORDS_RU, PARTS_RU)
    return [*words, *(w.capitalize() for w in words if language == "ru"), *parts]


class Automaton:
    """Entries as one tree of letters; parts are a point and any white space apart."""

    def __init__(self, found: Iterable[str], letter: str, space: str):
        self.tree: dict = {}
        for entry in found:
            at = self.tree
            for c in ".".join(entry.replace(".", " ").split()):
                at = at.setdefault(c, {})
            at[""] = True
        self.consonants = re.compile(rf"(?=[{letter}])[^\W\d_{VOWELS}{VOWELS.upper()}][^\W\d_{VOWELS}A-ZÀ-ÞЀ-Я]{{1,{MOST_CONSONANTS - 1}}}(?![{letter}])")
        self.space = re.compile(rf"{space}*")

    def end(self, text: str, at: int) -> int:
        """Where the longest entry at a place ends, before its last point; -1 without one. Behind an entry stands a point."""
        best = -1
        m = self.consonants.match(text, at)
        if m and text.startswith(".", m.end()):
            best = m.end()
        node, i = self.tree, at
        while True:
            if "" in node and text.startswith(".", i):
                best = max(best, i)
            if "." in node and text.startswith(".", i):
                node, i = node["."], self.space.match(text, i + 1).end()
            elif i < len(text) and text[i] in node:
                node, i = node[text[i]], i + 1
            else:
                return best


@lru_cache(maxsize=32)
def automaton(language: str, more: tuple[str, ...], letter: str, space: str) -> Automaton:
    """The automaton of a language and of more entries, made once in a process."""
    return Automaton([*entries(language), *more], letter, space)
