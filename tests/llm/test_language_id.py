import random
import zlib

from airsift.llm import language_id
from texts import awkward, documents

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schn", "ürf", "ost", "eng"], "cc": ["qué", "ñar", "illo", "dez"]}


def speech(rng, lang, count):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(count))


def test_held_out_accuracy_and_awkward_rows(spark):
    rng = random.Random(3)
    parts, truth = [], {}
    for place, lang in enumerate(SYLLABLES):
        rows = [(place * 1000 + k, speech(rng, lang, rng.randrange(3, 60))) for k in range(150)]
        truth |= {doc_id: lang for doc_id, _ in rows}
        parts.append(documents(spark, rows, lang=lang))
    parts.append(documents(spark, awkward(rng) + [(990, "123 456 !!"), (991, "漢字 漢字")], lang=None))
    docs = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    got = language_id.identify(docs).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, row in by_id.items():
        assert 0 <= row["score"] <= 1
        if doc_id is not None:
            assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
    out = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) / len(out) > 0.99
    assert all(by_id[k]["lang_pred"] == "und" and by_id[k]["score"] == 0 for k in (900, 901, 902, 912, 990))
    assert by_id[991]["lang_pred"] in SYLLABLES
    assert by_id[None]["held_out"] is False


def test_scores_equal_brute_force(spark):
    """Words first, then the longest n-grams of which one is known, counted plainly."""
    import math
    from collections import Counter

    rng = random.Random(9)
    rows = [(lang, k, speech(rng, lang, 30)) for lang in ("aa", "bb") for k in range(60)]
    rows = [(lang, k if lang == "aa" else 100 + k, text) for lang, k, text in rows]
    docs = documents(spark, [(k, t) for lang, k, t in rows if lang == "aa"], lang="aa").union(documents(spark, [(k, t) for lang, k, t in rows if lang == "bb"], lang="bb"))

    def grams(word, size):
        return [(size, word[i : i + size], i == 0, i + size == len(word)) for i in range(len(word) - size + 1)]

    counts = {0: {}, 1: {}, 2: {}, 3: {}, 4: {}}
    for lang, k, text in rows:
        if zlib.crc32(str(k).encode()) % 5 == 0:
            continue
        for word in text.split():
            for size in range(5):
                for key in [word] if size == 0 else grams(word, size):
                    counts[size].setdefault(key, Counter())[lang] += 1
    logs = {}
    for size, table in counts.items():
        table = {key: {l: c for l, c in n.items() if c >= language_id.LEAST_COUNT} for key, n in table.items()}
        table = {key: n for key, n in table.items() if n}
        totals = {l: sum(n.get(l, 0) for n in table.values()) for l in ("aa", "bb")}
        logs[size] = {key: [math.log((n.get(l, 0) + 0.5) / (totals[l] + 0.5 * len(table))) for l in ("aa", "bb")] for key, n in table.items()}

    def score(word):
        if word in logs[0]:
            return logs[0][word]
        for size in (4, 3, 2, 1):
            known = [logs[size][g] for g in grams(word, size) if g in logs[size]]
            if known:
                return [sum(k[j] for k in known) / len(known) for j in range(2)]
        return None

    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    for _, k, text in rows:
        own = [s for s in map(score, text.split()) if s]
        means = [sum(s[j] for s in own) / len(own) for j in range(2)]
        gap = (means[0] - means[1]) * min(len(own), 10)
        assert got[k]["lang_pred"] == ("aa" if gap >= 0 else "bb")
        assert abs(got[k]["score"] - 1 / (1 + math.exp(-abs(gap)))) < 1e-4


def test_a_rare_language_keeps_its_entries_beside_many_others(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, rare = [], "zurqo vexim plodda"
    for lang in range(6):
        words = ["".join(rng.choice(letters) for _ in range(9)) for _ in range(6_000)]
        rows += [(lang * 1000 + k, " ".join(words[60 * k : 60 * k + 60] * 3), f"l{lang}") for k in range(100)]
    # Each word twice in all, under the counts of the others.
    learned = [k for k in range(9000, 9050) if zlib.crc32(str(k).encode()) % 5][:2]
    rows += [(k, rare, "rr") for k in learned]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert sum(len(t.langs) for t in model.tables.values()) > 200_000
    place = model.languages.index("rr")
    assert (model.tables[0].langs == place).sum() == 3
    got = language_id.identify(spark.createDataFrame([(1, rare)], "doc_id long, text string"), model).collect()
    assert got[0]["lang_pred"] == "rr"


def test_nothing_to_learn_from_and_empty(spark):
    docs = documents(spark, ["some words"], lang=None)
    assert [tuple(r)[2:] for r in language_id.identify(docs).collect()] == [("und", 0.0)]
    assert language_id.identify(documents(spark, [])).count() == 0


def test_the_sample_is_bounded_by_bytes_and_languages(spark, monkeypatch):
    rng = random.Random(8)
    parts = []
    for place, lang in enumerate(SYLLABLES):
        parts.append(documents(spark, [(place * 1000 + k, speech(rng, lang, 40)) for k in range(200 - 50 * place)], lang=lang))
    docs = parts[0].union(parts[1]).union(parts[2])
    whole = language_id.fit(docs)
    monkeypatch.setattr(language_id, "BYTES_PER_LANGUAGE", 4_000)
    fewer = language_id.fit(docs)
    assert fewer.languages == whole.languages == sorted(SYLLABLES)
    assert 0 < len(fewer.tables[0].keys) < len(whole.tables[0].keys)
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 2)
    assert language_id.fit(docs).languages == ["aa", "bb"]
    assert language_id._share(10, 100, 2) == language_id._HASHED
    assert language_id._share(10, 16_000, 2) == language_id._HASHED // 4
    assert language_id._share(10, 0, 300) == language_id._HASHED
