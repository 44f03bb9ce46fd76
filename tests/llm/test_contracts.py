"""Cases that once broke a contract: letterless signs, clashing names, stores, hot lines, long words."""

import random
import string
import time
import tracemalloc

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tests.llm import plain
from tests.llm.test_operators import SF, frame, hard_rows, same, table, words  # noqa: F401

from tvtrail import session
from tvtrail.llm import contamination, language, quality, repeats, secrets, token_files


def test_op5_signs_that_are_no_letters(spark):
    rows = [(i, t, lang, None, None) for i, (t, lang) in enumerate(
        [(" ".join(words(40, k)), ("en", "de")[k % 2]) for k in range(20)])]
    model = language.train(frame(spark, rows), F.lit(True))
    signs = ["½ ²", "Ⅷ", "①②", "٣٤", "一二" [:0] + "〇", "__ 12", "́", "→ ☃ 😀"]
    assert [model.predict(t) for t in signs] == [("und", 0.0)] * len(signs)
    assert all(model.predict(t)[0] in {"en", "de"} for t in ("½ a", "漢", "ª", "ʰ", "Ⅷ é"))


def digest(out):
    rows = out.select("doc_id", "text", "repeats").collect()
    return [(r["doc_id"], len((r["text"] or "").encode()), bytes(r["repeats"]["kept"])) for r in rows]


def removed_plainly(rows):
    """The rest of each text, string by string."""
    first = {}
    known = [(i if i is not None else (1 << 63) - 1, i, (t or "").encode()) for i, t in rows]
    for order, _, t in known:
        for k in range(len(t) - 49):
            first[t[k:k + 50]] = min(first.get(t[k:k + 50], order), order)
    out = []
    for order, i, t in known:
        gone = set()
        for k in range(len(t) - 49):
            if first[t[k:k + 50]] < order:
                gone.update(range(k, k + 50))
        out.append((i, len(t), bytes(b for k, b in enumerate(t) if k not in gone)))
    return out


def line_in_every_document(n=400):
    rng = random.Random(9)
    line = "every document of this collection holds this very line of words, whatever else it says"
    other = "and some hold another line that is also rather long, so that its edges meet all sorts of text"

    def own():
        return "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(20, 120)))

    return [(i, own() + line + own() + (other + own() if i % 3 == 0 else "")) for i in range(n)] + [(n, None), (None, line), (n + 1, "")]


@pytest.mark.parametrize("hot, part, batch", [(1, 1, 3_000), (50, 20, 3_000), (400, 300, 20_000), (1 << 40, 1, 3_000)])
def test_op10_one_line_in_every_document(spark, monkeypatch, hot, part, batch):
    """Buckets divided by string give what whole buckets give, and a plain scan."""
    monkeypatch.setattr(repeats, "HOT_PLACES", hot)
    monkeypatch.setattr(repeats, "PART_PLACES", part)
    monkeypatch.setattr(repeats, "BATCH_BYTES", batch)
    monkeypatch.setattr(repeats, "INDEX_BATCH", 500)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 8_000)
    monkeypatch.setattr(repeats, "DEST_BYTES", 9_000)
    rows = line_in_every_document()
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows])
    same(digest(repeats.remove_repeats(docs)), removed_plainly(rows))


def test_op10_hard_rows_by_string(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_PLACES", 0)
    monkeypatch.setattr(repeats, "PART_PLACES", 7)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000)
    rows = hard_rows()
    same(digest(repeats.remove_repeats(frame(spark, rows))), removed_plainly([r[:2] for r in rows]))


def test_op10_parts_stay_small(spark, monkeypatch, tmp_path):
    """The largest group grows with the number of batches, not of documents that have a line."""
    sizes = {}
    original = repeats._scan_bucket

    for n in (300, 1200):
        rows = [(i, t, None, None, None) for i, t in line_in_every_document(n)]
        docs = frame(spark, rows)
        monkeypatch.setattr(repeats, "BATCH_BYTES", 30_000)
        monkeypatch.setattr(repeats, "BUCKET_BYTES", 4_000)
        for hot in (100, 1 << 40):
            monkeypatch.setattr(repeats, "HOT_PLACES", hot)
            monkeypatch.setattr(repeats, "PART_PLACES", 30)
            path = f"{tmp_path}/{n}-{hot}"

            def measured(dests, path=path):
                scan = original(dests)

                def run(rows):
                    with open(path, "a") as f:
                        f.write(f"{sum(map(len, rows['texts'])) + sum(map(len, rows['strings']))}\n")
                    return scan(rows)

                return run

            monkeypatch.setattr(repeats, "_scan_bucket", measured)
            repeats.remove_repeats(docs).count()
            with open(path) as f:
                sizes[n, hot] = max(map(int, f))
    assert sizes[1200, 1 << 40] > 3 * sizes[300, 1 << 40]  # undivided: with the documents
    assert sizes[1200, 100] < 2 * sizes[300, 100] and sizes[1200, 100] < sizes[1200, 1 << 40] / 5


def test_op10_keeps_columns_of_its_own_names(spark):
    line = "a line of more than fifty bytes that two documents of this table have"
    df = spark.createDataFrame([(1, line, "a", 7, b"s", "l", "x"), (2, line, "b", 8, b"t", "m", "y")],
                               "doc_id bigint, text string, _id string, _tie int, _starts binary, _lengths string, `odd.name` string")
    out = repeats.remove_repeats(df)
    assert set(out.columns) == {*df.columns, "repeats"}
    rows = sorted(out.collect(), key=lambda r: r["doc_id"])
    assert [(r["_id"], r["_tie"], bytes(r["_starts"]), r["_lengths"], r["odd.name"]) for r in rows] == [
        ("a", 7, b"s", "l", "x"), ("b", 8, b"t", "m", "y")]
    assert [bytes(r["repeats"]["kept"]) for r in rows] == [line.encode(), b""]


def test_op1_default_file_system_is_not_local(spark, tmp_path):
    """A path without a scheme belongs to the default file system, mounted or not."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    rows = [(i, t) for i, t, *_ in hard_rows() if i is not None]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    conf.set("fs.viewfs.mounttable.shared.link./shared", f"file://{tmp_path}")
    conf.set("fs.viewfs.mounttable.shared.link./tmp", "file:///tmp")  # where the tests' shared folder is
    try:
        conf.set("fs.defaultFS", "viewfs://shared/")
        token_files.write(docs, "/shared/t", plain.TOKENIZER)
        got = [tuple(r) for r in token_files.read(spark, "/shared/t").select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    finally:
        conf.set("fs.defaultFS", before)
    same(got, plain.token_files(rows))
    assert list((tmp_path / "t").glob("part-*"))


def test_op1_long_words_are_not_kept():
    encoder = token_files.Encoder(plain.TOKENIZER)
    rng = random.Random(2)
    tracemalloc.start()
    for k in range(60):
        text = "".join(rng.choice("acgt") for _ in range(20_000)) + " é" * (k % 2)
        assert len(encoder.encode(text)) > 1000
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 3e6 and all(len(w) <= 64 for w in (*encoder._plain, *encoder._coded))


def test_op8_column_names_with_dots(spark):
    items = spark.createDataFrame([(1, "one two three")], "`item.id` bigint, `the.text` string")
    docs = spark.createDataFrame([(1, "so One two three go"), (2, "no")], "doc_id bigint, `a.text` string")
    out = contamination.mark(docs, items, text="a.text", item_text="the.text", item_key="item.id")
    assert sorted((r["doc_id"], r["contamination"]["n_hit"], r["contamination"]["items"]) for r in out.collect()) == [(1, 3, [1]), (2, 0, [])]


def spans_of(out, *kinds):
    rows = out.select("doc_id", *[f"secrets.{k}" for k in kinds]).collect()
    return {r["doc_id"]: [[(s["start"], s["end"]) for s in r[k]] for k in kinds] for r in rows}


def keyed_texts(rng, n):
    """Prose with assignments, identifiers and bare keys, some of them side by side."""
    def key(size):
        return "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(size))

    out = []
    for k in range(n):
        parts = words(40, k)
        for _ in range(rng.randrange(4)):
            parts.insert(rng.randrange(len(parts)), rng.choice((
                f"token={key(40)}", f"passwd: {key(24)}+{key(20)}", "read_next_block_of_bytes", "AKIA" + key(20).upper(),
                "".join(rng.choice("0123456789abcdef") for _ in range(30)), key(rng.randrange(8, 40)), f"é{key(18)}.{key(18)}")))
        out.append(" ".join(parts))
    return [*out, *out[:5], "", None]


def test_op4_markov_spans_are_the_models(spark):
    """Trained and scored in plain Python, with copies among the rows, the spans are the same."""
    texts = keyed_texts(random.Random(41), 150)
    docs = frame(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratios = plain.markov_model(r["text"] or "" for r in known.select("text").collect())
    got = spans_of(secrets.scan(docs, secrets.train(known.union(known.limit(50)))), "assign", "access", "hex", "markov")
    want = {k: plain.markov_spans(t or "", ratios, sum(got[k][:3], [])) for k, t in enumerate(texts)}
    assert {k: v[3] for k, v in got.items()} == want
    assert sum(map(len, want.values())) > 50


def test_op4_models_do_not_depend_on_files(spark, monkeypatch):
    monkeypatch.setattr(secrets, "RANDOM_DOCS", 20)
    monkeypatch.setattr(secrets, "IDENTIFIER_DOCS", 30)
    texts = keyed_texts(random.Random(42), 150)
    rows = [(k, t, None, None, None) for k, t in enumerate(texts)]
    once = secrets.train(frame(spark, rows).coalesce(1))
    assert once == secrets.train(frame(spark, rows[::-1] + rows[:40]).repartition(7))
    assert any(once.ratios)


def test_op4_rare_labels_are_all_learnt_from(spark, monkeypatch):
    """Few documents hold a labelled string: the sample is drawn among them."""
    monkeypatch.setattr(secrets, "RANDOM_DOCS", 3)
    rows = [(k, " ".join(words(30, k)), None, None, None) for k in range(200)]
    rows += [(900 + k, f"token={'Zq9' * 8}", None, None, None) for k in range(2)]
    model = secrets.train(frame(spark, rows))
    at = secrets.ALPHABET.index
    assert model.ratios[at("Z") * len(secrets.ALPHABET) + at("q")] > 1


def test_op4_many_matches_in_one_text(spark):
    """Time grows with the text, not with matches times strings."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, rng = secrets.train(docs), random.Random(43)
    letters = string.ascii_letters + string.digits
    parts = ["".join(rng.choice(letters) for _ in range(20)) for _ in range(80_000)]
    text = " ".join(f"token={p}" if k % 2 else p for k, p in enumerate(parts))
    start = time.perf_counter()
    got = spans_of(secrets.scan(frame(spark, [(1, text, None, None, None)]), model), "assign", "markov")[1]
    assert time.perf_counter() - start < 60
    assert len(got[0]) == 40_000 and 39_000 < len(got[1]) <= 40_000
    assert all(text[a - 6:a] != "token=" for a, _ in got[1])


def test_op7_measures_of_the_rules(spark):
    rng = random.Random(44)
    letters = ["a", "ab", "b", "a.", "é", " ", "  ", "\t", "\n", " \n", "\x0b", "\x85", "\xa0", "$1"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)] + ["", "a" * 50_000, "a " * 50_000]
    pairs = [[x == y for x, y in zip(w, w[1:])] for w in (plain.BLANK.findall(t) for t in texts)]
    want = [(sum(p), sum(bool(plain.BLANK.search(n)) for n in t.split("\n"))) for p, t in zip(pairs, texts)]
    counts = [F.regexp_count("text", F.lit(p)) for p in (quality._STUTTER, quality._LINES)]
    got = spark.createDataFrame(list(enumerate(texts)), "n int, text string").select("n", *counts).orderBy("n").collect()
    assert [tuple(r)[1:] for r in got] == want


def test_op8_windows_by_blocks(monkeypatch):
    """Few words, many repeats and items of every length: as window by window, in steps of any size."""
    rng = random.Random(45)
    for window, letters, step in ((10, "ab", 7), (10, "abcdefgh", 1 << 18), (9, "ab", 1 << 18), (3, "abc", 5), (2, "abc", 1), (1, "abc", 9)):
        monkeypatch.setattr(contamination, "STEP_PAIRS", step)
        line = [rng.choice(letters) for _ in range(400)]
        items = [(n % 25, " ".join(line[a:a + rng.randrange(25)]).encode()) for n, a in enumerate(rng.randrange(400) for _ in range(30))]
        scanner = contamination.Scanner([*items, (99, None), (None, b"a, B; a")], window)
        wanted = {}
        for item, text in [*items, (None, b"a, B; a")]:
            w = contamination.words_of(text)
            for k in range(len(w) - min(window, len(w)) + 1 if w else 0):
                wanted.setdefault(tuple(w[k:k + window]), set()).add(item)
        for _ in range(30):
            a = rng.randrange(400)
            words = [w.encode() for w in line[a:a + 30] + [rng.choice(letters + "xy") for _ in range(rng.randrange(40))]]
            hit, found = set(), set()
            for w, ids in wanted.items():
                for k in range(len(words) - len(w) + 1):
                    if tuple(words[k:k + len(w)]) == w:
                        hit.update(range(k, k + len(w)))
                        found |= ids
            ranges, got = scanner.scan(words)
            assert got == found and {k for x, y in ranges for k in range(x, y)} == hit


def test_op8_large_benchmark(spark):
    """Four million letters of benchmark are one automaton; more than the bound is refused."""
    rng = random.Random(46)
    vocabulary = words(3000, 47)
    items = [(n, " ".join(rng.choices(vocabulary, k=600))) for n in range(1200)]
    tracemalloc.start()
    scanner = contamination.Scanner([(n, t.encode()) for n, t in items])
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 150e6
    for n in range(0, 1200, 40):
        w = items[n][1].encode().split()
        assert scanner.scan([b"so", *w[133:143], b"on"]) == ([(1, 11)], {n})
        assert scanner.scan([b"so", *w[133:142], b"on"]) == ([], set())
    bench = spark.createDataFrame(items[:9], "item_id bigint, text string")
    with pytest.raises(ValueError, match="benchmark"):
        contamination.mark(bench, bench, most_bytes=20_000)
    both = contamination.mark(bench.union(bench), bench, most_bytes=40_000)  # repeated rows
    assert sorted((r["item_id"], *r["contamination"]["items"]) for r in both.collect()) == sorted((n, n) for n in [*range(9)] * 2)


def test_pipeline_leaves_no_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    with session.working_tables(spark):
        assert corpus_pipeline.run(spark, SF).count() > 0
        # Documents of the last written stage, and what sharding reads.
        assert 1 <= len(list(tmp_path.iterdir())) <= 4
    assert not list(tmp_path.iterdir())
