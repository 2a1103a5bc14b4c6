"""Sharding, quality rules, source mixing and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from deedmill.llm import mixing, quality, sharding
from deedmill.llm.queries import LANG_SHARES, QUERIES
from deedmill.llm.tokenizers import default_path, load_units
from deedmill.session import staged
from tests.llm.data import CLASHES, SF, WORD, documents, least_reachable, odd_documents, rows_of, sample_documents, shingle_set, stored, with_clashes
from tests.llm.test_pii import plain_spans

# ---- sharding ----------------------------------------------------------------------


def check_law(rows, found, shards):
    assert Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows) == Counter(
        (r["doc_id"], r["size"], r["text_crc32"]) for r in found
    )
    slots = defaultdict(list)
    for r in found:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots.get(k, [])) for k in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_the_sample(spark):
    found = QUERIES["op7_sharding"](spark, SF).collect()
    check_law(sample_documents(), found, 8)


def test_groups_stay_together_and_a_giant_one_fills_shards(spark):
    rows = [{"doc_id": k, "text": f"group {k // 4}" if k < 400 else "giant" if k < 800 else f"own {k}"} for k in range(1200)]
    rows = [{**r, "lang": "en", "source": "s", "n_chars": 1} for r in rows]
    found = sharding.shard_documents(with_clashes(documents(spark, rows)), shards=5).collect()
    check_law(rows, found, 5)
    shard = {r["doc_id"]: r["shard"] for r in found}
    apart = sum(len({shard[k] for k in range(4 * g, 4 * g + 4)}) > 1 for g in range(100))
    assert apart <= 15  # at random all but one in a hundred
    assert len({shard[k] for k in range(400, 800)}) > 1


def test_shards_do_not_depend_on_the_layout(spark):
    docs = documents(spark)
    columns = ("doc_id", "size", "text_crc32", "shard", "slot")
    found = [rows_of(sharding.shard_documents(d), *columns) for d in (docs.coalesce(1), docs.repartition(7, "text"), docs.orderBy(F.desc("doc_id")))]
    assert found[0] == found[1] == found[2]


def test_fewer_equal_texts_are_apart_than_at_random(spark):
    rows = [r for r in sample_documents()]
    rows += [{**r, "doc_id": 10_000 + 3 * k + j} for k, r in enumerate(rows[:60]) for j in range(3)]
    found = sharding.shard_documents(documents(spark, rows)).collect()
    groups = defaultdict(Counter)
    for r in found:
        groups[r["text_crc32"], r["size"]][r["shard"]] += 1
    pairs = lambda n: n * (n - 1) // 2
    linked = sum(pairs(sum(g.values())) for g in groups.values())
    cut = linked - sum(pairs(n) for g in groups.values() for n in g.values())
    assert linked > 300 and cut < 0.2 * linked  # at random seven in eight


@pytest.mark.parametrize("rows", [[], odd_documents()[:3], odd_documents()])
def test_shards_of_odd_rows(spark, rows):
    check_law(rows, sharding.shard_documents(documents(spark, rows)).collect(), 8)


# ---- quality -----------------------------------------------------------------------


def plain_stats(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    times, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if times[w] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "base_failed": n < 50 or 100 * len(covered) > 50 * n,
    }


def plain_bucket_low(v):
    shift = max(0, v.bit_length() - 6)
    return v >> shift << shift


def plain_verdicts(rows):
    """The verdicts with sorted lists in place of sketches."""
    stats, values = [], defaultdict(list)
    for r in rows:
        s = plain_stats(r["text"])
        n, lines = max(1, s["n_words"]), max(1, s["n_lines"])
        s["metrics"] = {
            "symbols_per_word": 1000 * s["n_symbols"] // n,
            "duplicate_lines": 1000 * s["n_dup_lines"] // lines,
            "repeated_words": 1000 * s["n_repeat_words"] // n,
            "word_length": 100 * s["word_chars"] // n,
        }
        stats.append(s)
        for level in ((r["lang"], r["source"]), (r["lang"],), ()):
            for m, v in s["metrics"].items():
                if not s["base_failed"]:
                    values[level, m].append(plain_bucket_low(v))

    def summary(level, rule):
        v = sorted(values[level, rule.metric])
        if not v:
            return 0, None, None, None
        rank = lambda per: v[-(-per * len(v) // 1000) - 1]
        reach = lambda far: far * (100 + rule.beyond) // 100 + rule.slack
        mid = rank(500)
        return len(v), mid, reach(rank(rule.at) - mid), reach(mid - rank(1000 - rule.at))

    out = []
    for r, s in zip(rows, stats):
        kept = not s["base_failed"]
        for rule in quality.RULES:
            if s["base_failed"]:
                break
            own, lang, every = summary((r["lang"], r["source"]), rule), summary((r["lang"],), rule), summary((), rule)
            wide = every[2:] if lang[0] < quality.MIN_DOCS else [min(x, quality.WIDER * y) for x, y in zip(lang[2:], every[2:])]
            mid = own[1] if own[0] >= quality.MIN_DOCS else lang[1] if lang[0] >= quality.MIN_DOCS else every[1]
            if own[0] >= quality.MIN_DOCS:
                wide = [min(x, quality.WIDER * y) for x, y in zip(own[2:], wide)]
            kept &= s["metrics"][rule.metric] <= mid + wide[0]
            kept &= not rule.both or s["metrics"][rule.metric] >= mid - wide[1]
        row = (r["doc_id"], *[s[c] for c in QUALITY[1:7]], kept)
        out.append(row)
    return out


QUALITY = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_quality_query(spark):
    assert rows_of(QUERIES["op9_quality_rules"](spark, SF), *QUALITY) == Counter(plain_verdicts(sample_documents()))


@pytest.mark.parametrize("least, limit", [(100, 100_000), (5, 0)])
def test_quality_on_odd_rows(spark, monkeypatch, least, limit):
    monkeypatch.setattr(quality, "MIN_DOCS", least)
    monkeypatch.setattr(quality, "BROADCAST_GROUPS", limit)
    rows = sample_documents() + odd_documents()
    rows += [{**rows[0], "text": "a b c " * 40}, {**rows[0], "text": "x\ny\nx\n\n \nx"}, {**rows[0], "text": "z " * 30_000}]
    rows += [{**r, "lang": None} for r in sample_documents()[:30]]
    found = quality.judge(with_clashes(documents(spark, rows)), ["doc_id"])
    assert rows_of(found, *QUALITY) == Counter(plain_verdicts(rows))
    assert rows_of(quality.judge(with_clashes(documents(spark, rows)), ["doc_id", "text", "n"]), "doc_id", "kept") == Counter(
        (r[0], r[-1]) for r in plain_verdicts(rows)
    )


def with_metrics(spark, rows):
    stats = quality.text_stats(documents(spark, rows).select("lang", "source", "text"))
    return staged(stats.withColumns(quality.metrics()), "stats")


def test_cutoffs_follow_their_group_and_not_its_junk(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]

    def text(extra, symbols):
        return " ".join(rng.choices(words, k=120)) + " #" * rng.randint(0, symbols) + "".join(f"\n{w}" for w in extra)

    rows = []
    for source, n, junk, symbols in (("plain", 400, 0, 0), ("code", 400, 0, 12), ("dirty", 150, 0.4, 0), ("few", 20, 0, 0)):
        for k in range(n):
            body = text([], symbols) if rng.random() >= junk else " ".join(f"{w} $$$$" for w in rng.choices(words, k=80))
            rows.append({"doc_id": len(rows), "text": body, "lang": "en", "source": source, "n_chars": 0})
    cuts = {r["source"]: r.asDict() for r in quality.thresholds(with_metrics(spark, rows)).collect()}
    high = {s: c["high_symbols_per_word"] for s, c in cuts.items()}
    assert high["plain"] < high["few"] < 300 and high["plain"] < high["code"] < 300
    assert high["dirty"] < 500  # its own quantile is 4000
    found = {r["doc_id"]: r["kept"] for r in quality.judge(documents(spark, rows), ["doc_id"]).collect()}
    kept = Counter((r["source"], "$$$$" in r["text"]) for r in rows if found[r["doc_id"]])
    assert kept["dirty", True] == 0 and kept["plain", False] >= 395 and kept["code", False] >= 390 and kept["dirty", False] >= 80


def test_every_rule_rejects_something(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    stats = staged(quality.text_stats(docs.select("lang", "source", "text")).withColumns(quality.metrics()), "stats")
    cuts = quality.thresholds(stats)
    judged = stats.where(~quality.base_failed()).join(cuts, ["lang", "source"])
    n, *rejected = judged.agg(
        F.count("*"), *[F.count_if(F.col(r.metric) > F.col(f"high_{r.metric}")) for r in quality.RULES]
    ).first()
    assert all(0 < x < 0.08 * n for x in rejected)
    # symbols: no group of these tables uses any in a tenth of its texts
    assert all(cuts.select(f"high_{r.metric}").distinct().count() > 1 for r in quality.RULES[1:])


def test_quality_of_nothing(spark):
    assert quality.judge(documents(spark, []), ["doc_id"]).collect() == []


def test_buckets_keep_their_order(spark):
    values = [*range(300), 1023, 1024, 4095, 10**6, 2**40 + 5]
    df = spark.createDataFrame([(v,) for v in values], "v long").withColumn("b", quality.bucket(F.col("v")))
    rows = df.withColumn("low", quality.bucket_low(F.col("b"))).orderBy("v").collect()
    assert all(r["low"] == plain_bucket_low(r["v"]) for r in rows)
    assert all(a["b"] <= b["b"] for a, b in zip(rows, rows[1:]))


# ---- mixing ------------------------------------------------------------------------


def mixed_rows():
    rows = []
    for k in range(4000):
        source, lang = ("web", "books", "code", None)[min(k % 10, 9) // 3 if k % 10 < 9 else 3], ("en", "de", "fr")[(k // 7) % 3]
        rows.append({"doc_id": k, "text": f"w{k} " * (20 + k % 50), "lang": lang, "source": source, "n_chars": 0})
    return rows


def test_shares_are_met(spark):
    rows = mixed_rows()
    found = mixing.mix(
        with_clashes(documents(spark, rows)),
        keep_cols=["doc_id", "source", "lang"],
        lang_shares={"en": 0.5, "de": 0.3},
        source_power=0.5,
    ).collect()
    assert len(found) == len(rows)
    tokens, expected, drawn = Counter(), Counter(), Counter()
    for r in found:
        assert 0 <= r["probability"] <= 1 and r["n_tokens"] == len(rows[r["doc_id"]]["text"].split())
        for key in (r["source"], r["lang"]):
            tokens[key] += r["n_tokens"]
            expected[key] += r["n_tokens"] * r["probability"]
            drawn[key] += r["n_tokens"] * r["sampled"]
    total = sum(expected[x] for x in ("en", "de", "fr"))
    for lang, share in {"en": 0.5, "de": 0.3, "fr": 0.2}.items():
        assert abs(expected[lang] / total - share) < 1e-4
        assert abs(drawn[lang] / sum(drawn[x] for x in ("en", "de", "fr")) - share) < 0.03
    roots = {s: tokens[s] ** 0.5 for s in ("web", "books", "code", None)}
    for s, root in roots.items():
        assert abs(expected[s] / total - root / sum(roots.values())) < 1e-4
    assert max(r["probability"] for r in found) == 1


def test_rare_cells_do_not_press_the_others_down(spark):
    rows = mixed_rows() + [{"doc_id": 9999, "text": "tiny", "lang": "tiny", "source": "web", "n_chars": 4}]
    found = mixing.mix(documents(spark, rows), lang_shares={"tiny": 0.4})
    row = found.agg(F.sum(F.col("n_tokens") * F.col("probability")), F.sum("n_tokens")).first()
    assert row[0] / row[1] >= 0.9 / mixing.MAX_RATIO


def test_mixing_by_the_other_join_and_odd_rows(spark):
    rows = sample_documents() + odd_documents()
    columns = ("doc_id", "n_tokens", "probability", "sampled")
    want = rows_of(mixing.mix(documents(spark, rows)), *columns)
    assert sum(want.values()) == len(rows)
    assert rows_of(mixing.mix(with_clashes(documents(spark, rows)), broadcast_cells=0), *columns) == want
    none = {r: n for r, n in want.items() if r[0] in (1000, 1001, 1002)}
    assert none == {(k, 0, 0.0, False): 1 for k in (1000, 1001, 1002)}
    assert mixing.mix(documents(spark, [])).collect() == []
    assert rows_of(mixing.mix(documents(spark, odd_documents()[:2])), *columns) == {(1000, 0, 0.0, False): 1, (1001, 0, 0.0, False): 1}


# ---- the pipeline ------------------------------------------------------------------


def test_stages_against_brute_force(spark, tmp_path):
    rows = sample_documents() + [r for r in odd_documents() if r["doc_id"] is not None]
    docs = stored(with_clashes(documents(spark, rows)).withColumn("dotted.name", F.col("doc_id") * 2), tmp_path, "docs")
    columns = docs.columns
    assert {"_row_key", "_place", "kept", "n_words", "sampled", "topic"} <= set(columns)
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), tmp_path, name)
        after[name] = docs.collect()
        if name != "bpe_round_trip":
            assert docs.columns == columns
            assert all(r[c] == "clash" for r in after[name] for c in CLASHES if c not in ("text", "source"))
            assert all(r["dotted.name"] == 2 * r["doc_id"] for r in after[name])
    ids = {name: sorted(r["doc_id"] for r in found) for name, found in after.items()}
    verdict = plain_verdicts(rows)
    assert ids["quality_rules"] == sorted(r[0] for r in verdict if r[-1])
    left = [r for r in after["quality_rules"]]
    sets = [shingle_set(r["text"]) for r in left]
    least = {}
    for r, k in zip(left, least_reachable(sets, 80)):
        least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    assert ids["near_dedup"] == sorted(least.values())
    assert ids["personal_data"] == ids["near_dedup"]
    texts = {r["doc_id"]: r["text"] for r in after["near_dedup"]}
    for r in after["personal_data"]:
        if not plain_spans(texts[r["doc_id"]]):
            assert r["text"] == texts[r["doc_id"]]
        assert plain_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
    draws = mixing.mix(spark.read.parquet(str(tmp_path / "personal_data")), lang_shares=LANG_SHARES).where("sampled")
    assert ids["source_mixing"] == sorted(r["doc_id"] for r in draws.collect()) != []
    library = load_units(default_path("byte_bpe_50k.json")).library
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in after["source_mixing"]}
    assert {r["doc_id"]: list(r["ids"]) for r in after["bpe_round_trip"]} == want
    assert [r["n_tokens"] for r in after["bpe_round_trip"]] == [len(r["ids"]) for r in after["bpe_round_trip"]]


def test_run_is_the_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), tmp_path, name)
    found = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in found.collect()) == sorted(
        (r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in docs.collect()
    )


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = stored(documents(spark, []), tmp_path, "docs")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), tmp_path, name)
        assert docs.count() == 0
