"""The pipeline, stage by stage, against plain Python on what the stage before has stored."""

import unicodedata
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from test_copies import WORD, roots, shingles
from test_models import counts
from tokenizers import Tokenizer

import corpus_pipeline
from airgauge.llm import language_id, quality_rules
from airgauge.llm.common import stored, table

SF = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def chain(spark):
    """(rows in, rows out) of every stage by name; the last one's rows out as they are."""
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), name)
        last = name == corpus_pipeline.STAGES[-1][0]
        out[name] = (rows_of(docs), after.collect() if last else rows_of(after))
        docs = after
    return out


def shares(text):
    """The features that rules look at."""
    n_words, chars, symbols, dup, repeat, _ = counts(text)
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    over = lambda a, b: a / b if b else 0.0
    upper = sum(unicodedata.category(c) == "Lu" for c in text or "")
    return {
        "symbol_share": over(symbols, chars), "upper_share": over(upper, chars), "bang_share": over((text or "").count("!"), chars),
        "dup_line_share": over(dup, len(lines)), "repeat_share": over(repeat, n_words), "distinct_share": over(len(set(words)), n_words),
        "word_length": over(chars, n_words),
    }


def test_rules_stage(spark, chain):
    given, got = chain["quality_rules"]
    rules = quality_rules.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))

    def kept(text):
        x = shares(text)
        return not counts(text)[-1] and not any(all((x[c.feature] > c.cut) == c.above for c in rule) for rule in rules)

    assert got == [r for r in given if kept(r[1])] and 0 < len(got) < len(given)


def n_grams(text):
    """Letters, and pairs and triples of letters with a border beside each word, as the numbers that break ties."""
    out, word = [], []
    for c in [*text.lower(), " "]:
        if c.isalpha():
            word.append(ord(c))
        elif word:
            w = [language_id.BORDER, *word, language_id.BORDER]
            out += word + [a << 21 | b for a, b in zip(w, w[1:])] + [a << 42 | b << 21 | c for a, b, c in zip(w, w[1:], w[2:])]
            word = []
    return out


def by_rank(tally):
    return [g for g, _ in sorted(tally.items(), key=lambda x: (-x[1], x[0]))[: language_id.RANKS]]


def nearest(text, profiles):
    own = by_rank(Counter(n_grams(text or "")))
    if not own:
        return "und", 0.0
    best = None
    for name in sorted(profiles):
        place = {g: i for i, g in enumerate(profiles[name])}
        cost = sum(abs(place[g] - i) if g in place else language_id.RANKS for i, g in enumerate(own))
        if best is None or cost < best[0]:  # the first name of equals
            best = (cost, name)
    return best[1], 1.0 - best[0] / (language_id.RANKS * len(own))


def test_language_stage(chain):
    given, got = chain["language_id"]
    tallies = defaultdict(Counter)
    for id, text, lang, *_ in given:
        if zlib.crc32(str(id).encode()) % 4 != 2 and lang is not None and text is not None:
            tallies[lang].update(n_grams(text))
    profiles = {lang: by_rank(t) for lang, t in tallies.items()}
    said = {r[0]: nearest(r[1], profiles) for r in given}
    assert got == [r for r in given if said[r[0]][0] != "und" and said[r[0]][1] >= corpus_pipeline.LEAST_SCORE]


def test_languages_of_odd_texts(spark, docs, rows):
    """Names and scores of edge rows; of equally near languages the first by name."""
    learned = [("a", [ord("x"), ord("y")]), ("b", [ord("y"), ord("x")]), ("c", [ord("z")])]
    profiles = dict(learned)
    texts = [t for _, t, *_ in rows] + ["x y", "xy", "yx", "q", "z z"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in language_id.classified(df, learned).collect():
        name, score = nearest(texts[r.i], profiles)
        assert (r.lang_pred, round(r.score, 12)) == (name, round(score, 12)), texts[r.i]
    assert nearest("q", profiles)[0] == "a"  # nothing shared: all alike


def test_near_copies_stage(chain):
    given, got = chain["jaccard_join"]
    sets = [shingles(r[1]) for r in given]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = roots(len(given), pairs)
    least = {}
    for r, k in zip(given, root):
        least[k] = min(least.get(k, r[0]), r[0])
    assert got == [r for r, k in zip(given, root) if r[0] == least[k]]


def test_repeats_stage(chain):
    given, got = chain["substring_dedup"]
    words = {r[0]: WORD.findall(r[1] or "") for r in given}
    times = Counter(tuple(w[i : i + 35]) for w in words.values() for i in range(len(w) - 34))
    assert [r[0] for r in got] == [r[0] for r in given]
    cut = 0
    for before, after in zip(given, got):
        w = words[before[0]]
        gone = {j for i in range(len(w) - 34) if times[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        cut += len(gone)
        assert WORD.findall(after[1] or "") == [x for j, x in enumerate(w) if j not in gone]
        assert after[2:4] == before[2:4] and after[4] == len(after[1] or "")
    assert cut


def test_packing_stage(chain):
    given, got = chain["best_fit_packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, total = set(), 0
    for id, text, *_ in given:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.add((id, k // 4096, k, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) <= -(-total // 4096) + 1
