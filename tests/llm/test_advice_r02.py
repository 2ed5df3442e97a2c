"""What the second review found missing: each test failed before its finding was settled."""

import random

import pytest

import corpus_pipeline
from orebridge.llm import langid
from orebridge.llm.queries import QUERIES
from tests.conftest import SF_CHECK
from tests.llm.helpers import docs_rows, rows_of, write_tables


def passage_lines(texts: list[str], least: int) -> list[list[str]]:
    """Texts' lines without those in a run of `least` words or more that stands in an earlier
    text, by comparing every pair of lines of every pair of texts."""
    split, out = [t.split("\n") for t in texts], []
    for n, lines in enumerate(split):
        gone = set()
        for other in split[:n]:
            for i in range(len(lines)):
                for k in range(len(other)):
                    run = 0
                    while i + run < len(lines) and k + run < len(other) and lines[i + run] == other[k + run]:
                        run += 1
                    if len(" ".join(lines[i:i + run]).split()) >= least:
                        gone.update(range(i, i + run))
        out.append([x for i, x in enumerate(lines) if i not in gone])
    return out


def planted_passages(seed: int, cases: int, blank: str = " ") -> list[list[str]]:
    """Pairs of texts that share only a passage of 50-70 words on 2-12 lines."""
    rng = random.Random(seed)

    def line(n):
        return blank.join(f"w{rng.randrange(10 ** 9)}" for _ in range(n))

    out = []
    for _ in range(cases):
        words, count = rng.randint(50, 70), rng.randint(2, 12)
        cuts = [0, *sorted(rng.sample(range(1, words), count - 1)), words]
        body = [line(b - a) for a, b in zip(cuts, cuts[1:])]
        out.append(["\n".join([*(line(rng.randint(1, 45)) for _ in range(rng.randint(0, 6))), *body,
                               *(line(rng.randint(1, 45)) for _ in range(rng.randint(0, 6)))]) for _ in range(2)])
    return out


def test_wrapped_passages_go_whole(spark):
    pairs = planted_passages(7, 150) + planted_passages(8, 20, "\t") + planted_passages(9, 20, " ")
    rows = [(2 * n + k, text) for n, pair in enumerate(pairs) for k, text in enumerate(pair)]
    got = {r["doc_id"]: r for r in rows_of(QUERIES["op9_line_dedup"](spark, write_tables(documents=docs_rows(rows))))}
    for n, pair in enumerate(pairs):
        want = passage_lines(pair, 50)
        assert [got[2 * n + k]["text"] for k in (0, 1)] == ["\n".join(x) for x in want]
        assert got[2 * n + 1]["n_removed_lines"] == len(pair[1].split("\n")) - len(want[1])


PROSE = {"en": "The river runs down from the hills and the people of the town walk along it in the evening.",
         "de": "Der Fluss kommt aus den Bergen und die Leute der Stadt gehen am Abend an seinem Ufer entlang.",
         "und": "Rieka tečie z kopcov a ľudia z mesta sa večer prechádzajú po jej brehu až k mostu."}


@pytest.mark.parametrize("labels, want", [
    ({}, {}),                                       # nothing to learn from: lang stays null
    ({"en": "en", "de": "de", "und": "und"}, {"en": "en", "de": "de", "und": "und"})])
def test_language_stage_drops_only_letterless_documents(spark, labels, want):
    rows = [(n, PROSE[k], labels.get(k), "s", len(PROSE[k])) for n, k in enumerate(list(PROSE) * 8)]
    rows += [(100, "12 34 !", labels.get("en"), "s", 7), (101, None, None, "s", None), (102, "", None, "s", 0)]
    sf = write_tables(documents=rows)
    out = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert {r["doc_id"]: r["lang"] for r in rows_of(out)} == {n: want.get(k) for n, k in enumerate(list(PROSE) * 8)}


def test_language_stage_keeps_lang_where_all_labelled_rows_are_held_out(spark):
    sf = write_tables(documents=[(None, PROSE["en"], "en", "s", 1), (None, "7", "en", "s", 1)])
    out = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert [(r["text"], r["lang"]) for r in rows_of(out)] == [(PROSE["en"], "en")]


@pytest.mark.parametrize("tiny", ["ok", "hello", " 12 34 ", "7", "The quick brown fox."])
def test_a_tiny_language_takes_no_documents(spark, tiny):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang")
    rows = [r for r in rows_of(docs) if r["text"]]
    model = langid.fit(langid.training_sample(docs) | {"xx": [tiny]})
    names, _, _ = langid.classify(model, [r["text"] for r in rows])
    assert "xx" not in names
    assert sum(n == r["lang"] for n, r in zip(names, rows)) / len(rows) > 0.97
    assert ("xx" in model.languages) == any(c.isalpha() for c in tiny)


def test_a_letterless_sample_is_no_language():
    model = langid.fit({"xx": ["12 34 !"], "en": [PROSE["en"]]})
    assert model.languages == ["en"]
    assert langid.classify(model, [PROSE["en"], "12"])[0] == ["en", "und"]


def test_a_two_character_language_is_still_found():
    model = langid.fit({"en": [PROSE["en"] * 20], "de": [PROSE["de"] * 20], "xx": ["ok"]})
    assert langid.classify(model, ["okokokokokok ok okok", PROSE["en"], PROSE["de"]])[0] == ["xx", "en", "de"]


def test_many_short_items_do_not_hide_a_window(spark):
    shared = "r r r r r r r r r x1 x2 x3 x4"
    text = shared + "".join(f" own{i}" for i in range(187))
    items = [(0, shared)] + [(n, " ".join("r" * n)) for n in range(1, 6)]
    sf = write_tables(documents=docs_rows([(1, text)]), benchmark=items)
    got, = rows_of(QUERIES["op7_decontamination"](spark, sf))
    assert (got["n_words"], got["n_hit"], got["n_items"], got["contaminated"]) == (200, 13, 6, True)


def test_unspaced_prose_is_no_long_word(spark):
    rng = random.Random(3)

    def prose(first, last):
        return " ".join("".join(chr(rng.randint(first, last)) for _ in range(rng.randint(20, 30))) for _ in range(60))

    rows = [(1, prose(0x4E00, 0x9000)), (2, prose(0x3042, 0x3093)), (3, prose(0x0E01, 0x0E2E)), (4, prose(0x61, 0x7A))]
    got = rows_of(QUERIES["op4_quality_rules"](spark, write_tables(documents=docs_rows(rows))))
    assert {r["doc_id"]: (r["base_failed"], r["kept"]) for r in got} == {
        1: (False, True), 2: (False, True), 3: (False, True), 4: (False, False)}
