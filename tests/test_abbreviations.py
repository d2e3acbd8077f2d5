"""Abbreviations: the automaton against trying every entry, golden sentences of each kind, and linear time."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from quarry.functions.abbreviations import Automaton, entries
from quarry.functions.lexer import SPACE, Lexer
from quarry.operators.tokenizer import segment


def test_automaton_against_all_entries():
    rng = random.Random(4)
    found = ["Dr", "Dr med", "Drs", "i d R", "i d", "Ph D", "Maj -Gen", "a", "ab", "B A"]
    made = Automaton(found, "A-Za-z", SPACE)
    made.consonants = re.compile(r"(?!)")  # the rule for words of consonants is not looked at here
    plain = [re.compile(rf"\.{SPACE}*".join(map(re.escape, e.split(" "))) + r"(?=\.)") for e in found]
    for _ in range(5000):
        text = "".join(rng.choice(["Dr", "med", "s", ".", ". ", " ", "i", "d", "R", "Ph", "D", "Maj", "-Gen", "a", "b", "B", "A", "x", ".\n"]) for _ in range(rng.randrange(1, 9)))
        at = rng.randrange(len(text))
        assert made.end(text, at) == max([m.end() for p in plain if (m := p.match(text, at))], default=-1)


def test_tables_are_clean():
    for language in ("en", "de", "ru"):
        known = entries(language)
        assert len(known) > 100 and all(e == " ".join(e.split()) and "." not in e for e in known)


SENTENCES = {
    # titles, degrees, parts with points
    "en": [
        ["Prof. Smith, Maj. Lee and Lt.-Col. Ray met."], ["He has a B. Sc. from Ohio.", "She has none."], ["A Ph.D. Lee holds."], ["Maj.-Gen. Hays left.", "He ran."], ["Sens. Cox and Day spoke."], ["Rt. Hon. Lady Ann came."],
        # papers, places, measures, consonants alone
        ["See Fig. 3 and vol. II of it."], ["Cf. Ibid. p. 7 Miller said."], ["Acme Corp. Ltd. Inc. Smith sued."], ["It is in Calif. Mr. Lee went."], ["Take 3 oz. Sugar and 2 lbs. Flour."], ["Mt. Hood and St. Ives."], ["He spoke to Sgt. Bell."],
        # words that begin a sentence end one behind an abbreviation
        ["He came etc.", "However, it ended."], ["He came etc.", "The end was near."], ["They use tools etc. The Hague is far."], ["He saw Dr. A. Smith."], ["Born 1 Jan. 1950 he ran.", "It rained."], ["He likes pop.", "It sells."],
        ["This is the end.", "Of it, we know."], ["The U.S. Army came.", "We left."], ["He lives in the U.S.", "He is old."],
    ],
    "de": [
        ["Herr Prof. Meier kam i. d. R. Montags."], ["Das gilt z. B. Berlin.", "Danach nicht."], ["Abb. Zwei und Anm. Drei."], ["Er lebte 40 v. Chr.", "Der Mann starb."], ["Dr. rer. nat. Meier ging."], ["Am 3. Mai 1999 kam er.", "Es war kalt."],
        ["Die Fa. Huber u. a. Firmen."], ["Er kam usw.", "Diese Frau blieb."], ["Im 19. Jahrhundert."], ["Sie wohnt in der Bahnhofstr. Neun."], ["Das ist i. A. Richtig."], ["Vgl. Kap. Vier, bzw. Abs. Zwei."],
    ],
    "ru": [["Это т. е. Иван.", "Потом ушел."], ["См. Рис. 3.", "Далее."], ["Полн. собр. соч. Пушкина."], ["Он жил на ул. Ленина.", "Потом уехал."], ["В 5 в. до н. э. Рим рос."], ["Стоит 5 млн. руб. Иван платит."], ["Проф. Иванов пришел."]],
}


@pytest.mark.parametrize(("language", "want"), [(k, v) for k, vs in SENTENCES.items() for v in vs])
def test_golden_sentences(language, want):
    assert Lexer(language).sentences(" ".join(want)) == want


@pytest.mark.parametrize("unit", ["Dr. ", "B. Sc. ", "a.b.", "St. John said. ", "x", "(a. ", "i. d. R. ", "Lt.-"])
@pytest.mark.parametrize("language", ["en", "de"])
def test_long_texts_take_linear_time(unit, language):
    text = unit * (400_000 // len(unit))
    began = time.time()
    Lexer(language).tokens(text)
    assert time.time() - began < 30


def test_entries_of_ones_own(spark):
    docs = spark.createDataFrame([(1, "en", "The kwik. Bar opened. It closed."), (2, "de", "Der foo. Bar kam."), (3, None, None)], "id int, lang string, text string")
    found = {r.id: r.sentences for r in segment(docs, more={"en": ("kwik",), "de": ("foo",)}).select("id", F.col("sentences")).collect()}
    assert found == {1: ["The kwik. Bar opened.", "It closed."], 2: ["Der foo. Bar kam."], 3: None}
