"""Surviving records, token ids, leaked passages and wrongly decoded text."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rollbook.llm import leakage, mojibake, survivors, tokens

needs_vocabulary = pytest.mark.skipif(not os.path.exists(f"{tokens.FOLDER}/{tokens.VOCABULARY}"), reason="no vocabulary here")


def test_survivors(spark):
    rows = [
        ("k", 1, "(408) 555-1234 ext. 5", "see website", "low", "2025-01-03", "a"), ("k", 2, "555-1234", "mailto:A.b@x.Example ", " HIGH ", "2025-01-01T00:00:00Z", "b"), ("k", 3, "1-408-555-9999", "c@x.example", "high", "2025-01-02 00:00:00", "c"),
        ("tie", 5, "1111111111", None, None, None, "a"), ("tie", 4, None, "@x.example", "n/a", "junk", "b"), ("single", 6, "408 555 1234", "a@b.example", "high", "2025-01-01", "a"), (None, 7, "408 555 1234", "", "", "", "a"), (None, 8, "", "", "", "", "a"),
        ("hot", 9, "4085550000x12", "a at b.example", "medium", "2025-01-01", "a"), ("hot", 10, "(408) 555-0001", "x" * 20_000, "medium", "2025-01-01", "a"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "mirror_key string, row_id long, phone string, email string, confidence string, last_seen string, source string, rank string")
    got = {r.mirror_key: tuple(r)[1:] for r in survivors.surviving_records(df).collect()}
    assert got == {
        "k": ("4085559999", "c@x.example", "high", "2025-01-03T00:00:00"), "tie": ("", "", "", ""), "hot": ("4085550000", "", "medium", "2025-01-01T00:00:00"),
    }
    assert survivors.surviving_records(df.limit(0)).count() == 0


def test_quality_model_finds_bad_source(spark):
    rng = random.Random(2)
    rows = []
    for g in range(300):
        true = f"408555{g:04d}"
        for s, good in (("good", 0.97), ("fair", 0.9), ("bad", 0.2)):
            if rng.random() < 0.9:
                rows.append((f"k{g}", len(rows), true if rng.random() < good else f"510555{rng.randrange(10**4):04d}", "", s))
    df = spark.createDataFrame(rows, "mirror_key string, row_id long, phone string, email string, source string")
    judged, quality = survivors.judged_values(df)
    q = {r.source: r for r in quality.collect()}
    assert q["good"].specificity > q["bad"].specificity and q["good"].sensitivity > q["bad"].sensitivity
    kept = judged.where("kept").collect()
    right = sum(r.value == f"408555{int(r.mirror_key[1:]):04d}" for r in kept)
    # A lone wrong value of a fair source looks like a second true one, as fields may have several.
    assert right > 0.9 * len(kept) and right > 0.95 * 300
    none, nobody = survivors.judged_values(df.limit(0))
    assert none.count() == 0 and nobody.count() == 0


def test_quality_model_keeps_several_true_values(spark):
    """Two true phones to a group; sources leave out and make up values at rates that the fit must find again."""
    rng = random.Random(4)
    planted = {"a": (0.95, 0.97), "b": (0.85, 0.9), "c": (0.7, 0.95), "d": (0.6, 0.6)}
    rows, truth, false = [], set(), set()
    for g in range(500):
        values = {f"408{g:03d}{k}{rng.randrange(10**3):03d}": k < 2 for k in range(4)}
        for value, good in values.items():
            (truth if good else false).add((f"k{g}", value))
            for s, (sensitivity, specificity) in planted.items():
                if rng.random() < (sensitivity if good else 1 - specificity):
                    rows.append((f"k{g}", len(rows), value, "", s))
    df = spark.createDataFrame(rows, "mirror_key string, row_id long, phone string, email string, source string")
    judged, quality = survivors.judged_values(df)
    kept = {(r.mirror_key, r.value) for r in judged.where("kept").collect()}
    stated = {(r[0], r[2]) for r in rows}
    assert len(kept & truth) > 0.95 * len(truth & stated) and len(kept & truth) > 0.93 * len(kept)
    # Both numbers are among values that any source states: a value that none states is not seen.
    said = {(g, v, s) for g, _, v, _, s in rows}
    found = {r.source: r for r in quality.collect()}
    for s in planted:
        for values, number, states in ((truth & stated, found[s].sensitivity, True), (false & stated, found[s].specificity, False)):
            share = sum(((g, v, s) in said) == states for g, v in values) / len(values)
            assert abs(number - share) < 0.15, (s, states, number, share)
    order = sorted(found, key=lambda s: -found[s].sensitivity - found[s].specificity)
    assert order[0] == "a" and order[-1] == "d"


TEXTS = [
    None, "", " ", "Hello's world  \n\n x", "a" * 700, "中文字符，没有空格" * 60, "don't won't I'll 'll 's", "x " * 900, "\t\t  \n" * 200, "🏠🔑 é́ ​" * 50, "1234567890" * 40, "<|endoftext|> stays text " * 30, "''''''lllll'll" * 40,
]


@needs_vocabulary
@pytest.mark.parametrize("chunk,overlap", [(20_000, 1_000), (64, 16), (50, 5), (7, 3)])
def test_ids_equal_the_library(spark, chunk, overlap):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(f"{tokens.FOLDER}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    df = spark.createDataFrame([(k, t, "clash", [1]) for k, t in enumerate(TEXTS)], "doc_id long, text string, doc string, ids array<int>")
    got = {r.doc_id: r.ids for r in tokens.encode_corpus(df, chunk=chunk, overlap=overlap).collect()}
    assert got == {k: other.encode(t or "", add_special_tokens=False).ids for k, t in enumerate(TEXTS)}
    back = {r.doc_id: r.text for r in tokens.decode_corpus(tokens.encode_corpus(df, chunk=chunk, overlap=overlap)).collect()}
    assert back == {k: t or "" for k, t in enumerate(TEXTS)}


@needs_vocabulary
def test_query_stitches_ordinary_documents(spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sum(bool(t) and len(tokens.stitches(t)) > 0 for t in texts) > 0.2 * len(texts)


@needs_vocabulary
def test_no_documents(spark):
    assert tokens.encode_corpus(spark.createDataFrame([], "doc_id long, text string")).count() == 0


ITEM = ("the retired surveyor who measured stramelobemb found that ninety balconies hang over land that drilmomeknench had never agreed to sell with one ornate"
        " beehive polished per oar in the yard of strangidacloth while each of the older tenants kept a separate ledger for the winter")


def noisy(words, rng):
    out = []
    for k, w in enumerate(words):
        if k % 9 == 4:
            w = rng.choice(["", "changed", f"{w} added"])
        out.append(w)
    return " ".join(x for x in out if x)


def test_leaks(spark):
    rng = random.Random(5)
    words = ITEM.split()
    n = len(words)
    filler = " ".join(rng.choice("notice waitlist housing applicants office city lottery unit rent".split()) for _ in range(400))
    texts = {
        1: ITEM, 2: f"{filler} <b>{ITEM.upper()}</b>, {filler}", 3: filler, 4: f"{filler}\n> {noisy(words, rng)}\n{filler}", 5: f"{' '.join(words[: n // 3])} {filler} {' '.join(words[n // 3 : 2 * n // 3])}",
        6: " ".join(words[: n // 2 - 6]), 7: " ".join(rng.sample(words, n)), 8: None, 9: "", 10: f"{filler} " * 60 + ITEM, 11: ITEM.replace(" ", " *​ "), 12: " ".join(words[: n // 5]) + filler + " ".join(words[n // 5 : 2 * n // 5]) + filler + " ".join(words[2 * n // 5 : 3 * n // 5]),
    }
    docs = spark.createDataFrame([(k, t, 1.0) for k, t in texts.items()] + [(1, ITEM, 1.0)], "doc_id long, text string, share double")
    items = spark.createDataFrame([(7, ITEM, "x"), (8, None, "x"), (9, "", "x"), (10, "too short", "x")], "item_id long, text string, suite string")
    got = sorted((r.doc_id, r.item_id) for r in leakage.leaks(docs, items).collect())
    assert got == [(k, 7) for k in (1, 1, 2, 4, 5, 10, 11)]
    assert leakage.leaks(docs.limit(0), items).count() == 0 and leakage.leaks(docs, items.limit(0)).count() == 0


def test_second_passage_behind_many_copies_of_a_formula():
    """A formula sentence of the item, repeated more often than the passage that completes the half is long."""
    words = [f"w{k}" for k in range(60)]
    formula, large, second = words[:12], words[:20], words[40:50]
    filler = [f"f{k}" for k in range(40)]
    text = [w for part in ([large] + [formula] * 60 + [second]) for w in part + filler]
    codes, item = leakage.codes_of(text), leakage.codes_of(words)
    hits = leakage.ItemIndex([(1, " ".join(words))]).hits(codes)[1]
    assert leakage.held_share(codes, item, hits) == 0.5


def leaked(item, text):
    index, codes = leakage.ItemIndex([(1, item)]), leakage.codes_of(leakage.words_of(text))
    if (0, 1) in index.stand_whole([codes]):
        return 1.0
    hits = index.hits(codes)
    return leakage.held_share(codes, index.codes[1], hits[1]) if 1 in hits else 0.0


def test_more_copies_of_a_passage_lose_nothing():
    words = [f"w{k}" for k in range(60)]
    shares = {n: leaked(" ".join(words), " ".join((words[:16] + [f"f{k}" for k in range(40)]) * n + words[30:45])) for n in (1, 10, 60, 400)}
    assert len(set(shares.values())) == 1 and shares[1] > 0.5


def test_short_items_and_scripts_without_blanks():
    assert leaked("alpha beta gamma delta epsilon", "so: Alpha beta, gamma <b>delta</b> epsilon!") == 1.0
    assert leaked("alpha beta gamma delta epsilon", "alpha beta gamma delta and epsilon") == 0.0
    chinese = "请注意该住房项目的申请截止日期为五月三日"
    assert leaked(chinese, f"前言很长很多字{chinese}后面还有其他内容和说明") == 1.0
    assert leaked(chinese, "前言很长很多字后面还有其他内容和说明") == 0.0


@pytest.mark.parametrize("every", [4, 5, 6, 8])
def test_isolated_changes_are_borne(every):
    words = [f"w{k}" for k in range(120)]
    assert leaked(" ".join(words), " ".join(w if k % every else f"new{k}" for k, w in enumerate(words))) >= 0.5
    assert leaked(" ".join(words), " ".join(f"{w} more" if k % every == 0 else w for k, w in enumerate(words))) >= 0.5
    if every > 4:
        assert leaked(" ".join(words), " ".join(w for k, w in enumerate(words) if k % every)) >= 0.5


def test_leaks_in_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(30))) for k in range(6)], "item_id long, text string")
    docs = items.select(F.col("item_id").alias("doc_id"), "text")
    monkeypatch.setattr(leakage, "BLOCK_WORDS", 60)
    assert sorted((r.doc_id, r.item_id) for r in leakage.leaks(docs, items).collect()) == [(k, k) for k in range(6)]


def test_masks_meet_every_stretch():
    """Two changed words at least three apart leave a mask whole somewhere in eleven words."""
    for a in range(11):
        for b in range(a + 3, 11):
            assert any(all(s + p not in (a, b) for p in m) for m in leakage.MASKS for s in range(11 - m[-1]))


SPANISH = "La lista de espera abrirá el lunes; también habrá una reunión sobre la construcción. Después, niños y jóvenes recibirán información según la región."
RUSSIAN = "Приём заявлений начнётся в понедельник, семьи получат приглашение на собеседование после жеребьёвки."
CHINESE = "候补名单将于明天开放，收到申请后关闭。家庭收入不得超过地区中位收入。"


def corpus():
    clean = [SPANISH, RUSSIAN, CHINESE, "The manager’s “list” — 5½ weeks, 68 °F, café", "┌──────┐\n│ 1BR │\n└──────┘", "INFORMAÇÃO: NÃO SÃO ACEITAS INSCRIÇÕES", "🏠🔑 emoji ​", None, "", "plain ascii ? text"]
    return [(k, f"{t} {k}" if t else t) for k, t in enumerate(clean * 12)]


DAMAGE = {
    1001: ("utf-8", "cp1252", SPANISH), 1002: ("utf-8", "latin-1", SPANISH), 1003: ("utf-8", "mac_roman", SPANISH), 1004: ("utf-8", "cp437", SPANISH), 1005: ("cp1251", "latin-1", RUSSIAN), 1006: ("cp1251", "cp866", RUSSIAN), 1007: ("utf-8", "latin-1", CHINESE),
    1008: ("cp1252", "cp1251", SPANISH), 1009: ("gbk", "latin-1", CHINESE), 1010: ("utf-8", "latin-1", RUSSIAN),
}


def test_wrong_sets_are_found_and_restored(spark):
    rows = corpus()
    for k, (true, read, text) in DAMAGE.items():
        rows.append((k, text.encode(true).decode(read, "ignore" if read == "cp1252" else "strict")))
    rows.append((1101, SPANISH.encode("cp1252").decode("utf-8", "replace")))
    rows.append((1102, "sound line\n" + SPANISH.encode("utf-8").decode("latin-1").encode("utf-8").decode("latin-1")))
    rows.append((1103, "x" * 100_000 + " cafÃ© y habrÃ¡ lÃ­nea"))
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, restored string")
    got = {r.doc_id: r.restored for r in mojibake.repaired(df).collect()}
    assert set(got) == set(DAMAGE) | {1101, 1102, 1103}
    for k, (_, read, text) in DAMAGE.items():
        if read != "cp1252":
            assert got[k] == text, k
    assert sum(a == b for a, b in zip(got[1101], SPANISH)) > 0.97 * len(SPANISH)
    assert got[1102] == "sound line\n" + SPANISH and got[1103].endswith(" café y habrá línea")
    assert mojibake.repaired(df.limit(0)).count() == 0
