import base64
import gzip
import hashlib
import math

import numpy as np
import oracle
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import AWKWARD, prose

import corpus_pipeline
import test_text_operators as plain
from rosterlens.llm import ann, chat, langid, licenses, quality, queries, warc

SF_DIR = "/root/testdata/sf0.001"


# -- licenses


def test_license_scan_equals_its_oracle(spark):
    assert oracle.spark_rows(queries.op1_license_scan(spark, SF_DIR)) == oracle.duck(SF_DIR, queries.ORACLES["op1_license_scan"])


def test_altered_notices(spark, awkward, nothing):
    notice = licenses.TEMPLATES["MIT-permission"]
    words = notice.split()
    texts = [notice, "x " * 40 + notice.upper() + " y" * 40, " ".join([*words[:-1], "files"]), " ".join(words[:8] + ["other"] * 12), "Released under the MIT", "RELEASED, under the mit license!", None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.license): (r.containment, r.first_word) for r in licenses.scan(rows).collect()}
    assert got[0, "MIT-permission"][0] == got[1, "MIT-permission"][0] == 1.0 and 30 < got[1, "MIT-permission"][1] <= 40
    assert got[2, "MIT-permission"][0] >= 0.8 and got[5, "MIT"] == (1.0, 0)
    assert {i for i, _ in got} == {0, 1, 2, 5}
    assert licenses.scan(nothing).count() == 0 and licenses.scan(awkward).count() == 0


def test_repeated_rows_and_long_texts_with_notices(spark, monkeypatch):
    monkeypatch.setattr(licenses, "PART", 50)
    notice = licenses.TEMPLATES["MIT"]
    rows = [(1, notice), (1, notice), (1, "see: " + notice), (None, notice), (2, (notice + " ") * 2000), (3, prose(8, 3000) + " " + licenses.TEMPLATES["ISC-text"] + " " + prose(9, 300))]
    got = {(r.doc_id, r.license): (r.containment, r.first_word, r.n_windows) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, "MIT"] == (1.0, 0, 2) and got[None, "MIT"] == (1.0, 0, 1)  # places 0 and 1
    assert got[2, "MIT"] == (1.0, 0, 2000)
    assert got[3, "ISC-text"][0] == 1.0 and 2950 < got[3, "ISC-text"][1] <= 3000


def test_every_template_is_found_by_the_text_it_names(spark):
    names = sorted(licenses.TEMPLATES)
    rows = [(i, prose(i, 60) + " " + licenses.TEMPLATES[name] + " " + prose(i + 50, 30)) for i, name in enumerate(names)]
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i, name] >= 0.94 for i, name in enumerate(names))  # a text that repeats a shingle is longer than its window
    assert licenses.groups({"a": "x " * 30, "b": "y " * 30, "c": "z " * 70}, 60) == [{"a": "x " * 30, "b": "y " * 30}, {"c": "z " * 70}]


# -- WARC


def test_archives(spark, nothing):
    html = [None, "", "same", "same", "same", "a\r\n\r\nb", "é漢" * 100, None]
    urls = ["http://A.Example.com/x?q=1#f", None, "not a url", "https://u@b.example.com:8080/ y", "", "http://a.example.com/x?q=1", "ftp://x", "http://a.example.com"]
    ids = [10, 11, -5, 3, 4, 6, 7, None]
    pages = spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in zip(ids, urls, html, strict=True)], "page_id long, url string, html string, size int, key string")
    got = {r.page_id: r for r in warc.archive_and_read(pages).collect()}
    assert set(got) == set(ids)
    groups = {}
    for i, h in zip(ids, html, strict=True):
        groups.setdefault((h or "").encode(), []).append(i)
    for raw, own in groups.items():
        first = max(i for i in own if i is not None)
        for i in own:
            assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
            assert (got[i].record_type, got[i].refers_to) == (("response", None) if i == first else ("revisit", first))
    assert {r.record_type for r in warc.archive_and_read(pages, revisit_from=5).collect()} == {"response"}
    assert warc.archive_and_read(nothing.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("source").alias("html"))).count() == 0
    twice = pages.unionByName(pages)
    assert warc.archive_and_read(twice).count() == 16


def test_index_and_archives_hold_the_same_records(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.example.com/{i % 7}", f"<p>{i % 40}</p>") for i in range(120)], "page_id long, url string, html string")
    shards = [r.asDict() for r in warc.write_archives(pages).collect()]
    found, stored = [], []
    for s in shards:
        system, root = warc._file_system(s["folder"])
        stored += [(r["page_id"], r["payload"]) for r in warc.read_stream(system.open_input_file(f"{root}/{s['archive']}").read())]
    index = warc.Index(shards)
    for row in pages.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("k")).collect():
        found += [(r["page_id"], r["payload"]) for r in index.records(row.k)]
    assert sorted(found) == sorted(stored) and len(found) == 120
    assert list(index.find("com,example,nowhere)/ 1")) == []
    assert {p for _, p in found if p} == {f"<p>{i}</p>".encode() for i in range(40)}


def test_archives_equal_their_oracle(spark):
    assert oracle.spark_rows(queries.op2_warc(spark, SF_DIR)) == oracle.duck(SF_DIR, queries.ORACLES["op2_warc"])


def test_long_pages_and_a_payload_of_most_pages(spark):
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('http://h.example.com/', id) AS url", "CASE WHEN id = 7 THEN repeat('long ', 2000000) WHEN id % 3 > 0 THEN 'missing' ELSE concat('p', id) END AS html")
    got = {r.page_id: r for r in warc.archive_and_read(pages).collect()}
    assert len(got) == 3000 and got[7].payload_bytes == 10_000_000
    assert {r.refers_to for r in got.values() if r.record_type == "revisit"} == {2999}
    assert sum(r.record_type == "revisit" for r in got.values()) == 1998


def test_records():
    raw = warc.record(7, "http://x\ny", b"\r\n\r\nbody", 8, warc.base32(hashlib.sha1(b"\r\n\r\nbody").hexdigest()), None, "response")
    assert warc.read_record(gzip.decompress(gzip.compress(raw)))["payload"] == b"\r\n\r\nbody"
    with pytest.raises(ValueError):
        warc.read_record(raw[:-1])


# -- nearest neighbours


def exact(ids, x, q, k):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
    d[ids == q] = np.inf
    order = np.lexsort((ids, d))[:k]
    return [(int(ids[i]), float(d[i])) for i in order if np.isfinite(d[i])]


def test_small_sets_are_searched_exactly(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)).astype(np.float32).astype(float)
    x[50:60] = x[49]
    rows = [(i, v.tolist(), 0, "x") for i, v in enumerate(x)]
    odd = [(1000, None, 0, ""), (1100, [0.0] * 8, 0, ""), (1200, [float("nan")] * 8, 0, ""), (1300, [1.0, None] * 4, 0, ""), (1400, [1.0] * 3, 0, ""), (None, [1.0] * 8, 0, ""), (1500, [float("inf")] * 8, 0, ""), (1600, [], 0, "")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, part int, ids string")
    got = ann.nearest(frame, every=50).collect()
    ids = np.arange(300)
    for q in range(0, 300, 50):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        want = exact(ids, x, q, 10)
        assert [r.rank for r in own] == list(range(1, 11)) and [r.vec_id for r in own] == [i for i, _ in want]
        assert np.allclose([r.score for r in own], [s for _, s in want], rtol=1e-14)
    assert {r.query_id for r in got} == set(range(0, 300, 50))
    assert ann.nearest(frame.limit(0)).count() == 0
    few = ann.nearest(frame.where("vec_id in (0, 1, 2)"), every=1).collect()
    assert len(few) == 6
    assert ann.nearest(frame.unionByName(frame), every=50).count() == 60


def test_learned_partitions_find_nine_in_ten(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 16))
    x[1000:2300] = x[0]  # a third of all rows
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(frame, every=40).collect()
    ids, hits = np.arange(4000), []
    for q in range(0, 4000, 40):
        want = {i for i, _ in exact(ids, x, q, 10)}
        own = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)]
        assert len(own) == len(set(own)) == 10 and q not in own
        hits.append(len(want & set(own)) / 10)
    assert np.mean(hits) >= 0.9
    assert sorted(r.vec_id for r in got if r.query_id == 1000) == [0, *range(1001, 1010)]


def test_ties_at_the_last_rank_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)  # several blocks and tasks of a partition
    monkeypatch.setattr(ann, "BLOCKS_PER_TASK", 2)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2000, 8))
    x[500:540] = x[500] + np.eye(8)[0] * 1e-3  # forty at one distance of the query 500
    x[500] -= np.eye(8)[0] * 1e-3
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = sorted((r.rank, r.vec_id) for r in ann.nearest(frame, every=500).collect() if r.query_id == 500)
    assert got == [(k + 1, 501 + k) for k in range(10)]


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e300])
def test_sizes_whose_squares_leave_the_doubles(spark, size):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(40, 4))
    x[20:] *= size
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann.nearest(frame, every=10).collect()}
    assert len(got) == 40
    for q in range(0, 40, 10):
        d = [(math.hypot(*(x[i] - x[q])), i) for i in range(40) if i != q]
        for k, (score, i) in enumerate(sorted(d)[:10]):
            assert got[q, k + 1][1] == pytest.approx(score, rel=1e-12)
            assert got[q, k + 1][0] == i or size < 1  # the tiny ones are at one distance of the others


@pytest.mark.parametrize(("rows", "most"), [(4000, 0.5), (40000, 0.35)])
def test_clustered_vectors_need_few_partitions(rows, most):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(100, 16))[rng.integers(100, size=rows)] * 3 + rng.normal(size=(rows, 16)) * 0.5
    router = ann.fit(x[: ann.SAMPLE_LEAST], ann.levels_for(rows))
    own, asked = router.probable(x, 0.0).argmax(axis=1), router.probable(x[:200], ann.COVERAGE)
    found, read = [], []
    for i in range(200):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        found.append(asked[i][own[np.argsort(d)[:10]]].mean())
        read.append(asked[i][own].mean())
    assert np.mean(found) >= 0.95 and np.mean(read) < most


def test_partitions_follow_the_rows():
    assert [ann.levels_for(n) for n in (0, 1, 10**5, 10**6, 10**12)] == [4, 4, 5, 7, 7]


def test_partitions_are_balanced():
    x = np.random.default_rng(7).normal(size=(1024, 8))
    graph = ann.neighbour_graph(x, 10)
    part = ann.partition_graph(x, graph, 3)
    assert np.bincount(part).tolist() == [128] * 8
    shuffled = np.random.default_rng(8).permutation(part)
    assert (part[graph] == part[:, None]).mean() > 1.5 * (shuffled[graph] == shuffled[:, None]).mean()


# -- chat


def conversations(spark):
    rows = [(1, 0, "system", None), (1, 1, "user", queries.HOSTILE), (1, 2, "assistant", "<\\|im_end|> <|<| ok\\<|"), (2, None, None, "x"), (2, 1, "assistant", ""), (2, 1, "assistant", "tie"), (2, 1, "assistant", "tie"), (None, 0, "assistant", "é漢<"), (3, 0, "a\\n\n<|im_start|>b", "|im_end|>")]
    return spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, segment int"), rows


def test_chat(spark):
    frame, rows = conversations(spark)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.text_parts(frame))).collect()}
    for conv in (1, 2, None, 3):
        own = [(r, t) for c, _, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", chat.segment(x[2], [{"type": "text", "text": x[3]}])[0]))]
        turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in own)
        learned = "".join(t or "" for r, t in own if r == "assistant")
        x = got[conv]
        assert (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert x.formatted_chars == sum(len(chat.segment(r, [{"type": "text", "text": t}])[0]) for r, t in own)
    assert chat.read_back(chat.format_turns(chat.text_parts(frame.limit(0)))).count() == 0


def test_typed_parts():
    parts = [{"type": "text", "text": "see <|image|> "}, {"type": "image", "ref": "a.png", "width": 57, "height": 28}, {"type": "audio", "ref": "b.wav", "seconds": 1.5}, {"type": "document", "ref": "c.pdf", "pages": 2}, {"type": "text", "text": " done"}]
    text, flat = chat.segment("assistant", parts)
    assert text == "<|im_start|>assistant\nsee <\\|image|> <|image|><|audio|><|document|> done<|im_end|>\n"
    assert [(a["type"], a["ref"], a["tokens"]) for a in flat.attachments] == [("image", "a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 1024)]
    assert all(text[a["at"] :].startswith(chat.PLACEHOLDERS[a["type"]]) for a in flat.attachments)
    assert [chat.unescape(text[s["start"] : s["stop"]]) for s in flat.loss] == ["see <|image|> ", " done"]
    text, flat = chat.segment("user", [{"type": "video", "ref": "d.mp4"}, None, {"type": None, "text": "x"}])
    assert text == "<|im_start|>user\n<|other|>x<|im_end|>\n" and [(a["type"], a["ref"], a["tokens"]) for a in flat.attachments] == [("video", "d.mp4", 0)]


_CONTROL = st.sampled_from(["<", "|", "\\", "<|", "|im_end|>", "\n", "|im_start|>assistant\n", "|image|>", "x", "", None])


@settings(max_examples=500, deadline=None)
@given(_CONTROL, st.lists(st.one_of(st.none(), st.builds(lambda t: {"type": "text", "text": t}, st.lists(_CONTROL, max_size=4).map(lambda x: "".join(filter(None, x)) or None)), st.sampled_from([{"type": k, "ref": "r", "width": 1, "height": 1, "seconds": 1.0, "pages": 1} for k in ("image", "audio", "document", "video")])), max_size=8))
def test_parts_come_back_as_one_turn(role, parts):
    text, flat = chat.segment(role, parts)
    want = []
    for part in parts:
        if part is None or (part["type"] == "text" and not part["text"]):
            continue
        if part["type"] == "text" and want and want[-1][0] == "text":
            want[-1] = ("text", want[-1][1] + part["text"])
        else:
            want.append(("text", part["text"]) if part["type"] == "text" else ("placeholder", chat.PLACEHOLDERS.get(part["type"], chat.OTHER)))
    assert list(chat.read_parts(text)) == [(role or "", want)]
    assert [(r, c) for r, c in chat.read_segment(text)] == [(role or "", "".join(t for _, t in want))]
    assert [a["at"] for a in flat.attachments] == [a["at"] for a in flat.attachments if text.startswith(chat.PLACEHOLDERS.get(a["type"], chat.OTHER), a["at"])]
    learned, own = chat.segment(chat.LEARNED_ROLE, parts)
    assert "".join(chat.unescape(learned[s["start"] : s["stop"]]) for s in own.loss) == "".join(t for k, t in want if k == "text")


def test_chat_equals_its_oracle(spark):
    assert oracle.spark_rows(queries.op6_chat_format(spark, SF_DIR)) == oracle.duck(SF_DIR, queries.ORACLES["op6_chat_format"])


def test_long_conversations_and_turns(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"{i} <|") for i in range(20000)] + [(2, 0, "assistant", "<|im_end|>" * 200_000)]
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.text_parts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    assert (got[1].n_turns, got[1].loss_chars) == (20000, sum(len(t) for _, i, _, t in rows[:-1] if i % 2)) and got[2].loss_chars == 2_000_000


@pytest.mark.parametrize("text", ["<|", "<\\|", "<\\\\|x", "<<|", "|>", "\\", "<|im_end|>\n<|im_start|>"])
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


# -- pipeline


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = stage(spark, docs, SF_DIR).cache()
        if k < 4:
            assert docs.columns == columns and docs.count() <= before
    ran = corpus_pipeline.run(spark, SF_DIR)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, ran.select(*key).collect())) == sorted(map(tuple, docs.select(*key).collect()))


def test_stages_equal_plain_versions(spark):
    """Each stage on its own input: the rows that stay, and what is left of their texts, by the plain versions of the operators' tests."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) < 6000")
    model = quality.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    def left(name):
        return sorted((r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)[name](spark, docs, SF_DIR).collect())

    def good(text):
        logit = model.bias + sum(model.weights[k] * v for k, v in plain.plain_features(text).items())
        return 1 / (1 + np.exp(-(model.slope * logit + model.shift))) >= quality.KEEP_AT

    assert left("quality rules") == sorted((i, t) for i, t in rows if not plain.base(t)[5] and good(t))
    names, scores = langid.train(docs).predict(pa.array([t for _, t in rows]))
    assert left("language") == sorted(x for x, n, s in zip(rows, names, scores, strict=True) if n != "und" and s >= langid.KEEP_AT)
    roots = plain.plain_components([plain.plain_fingerprint(t) for _, t in rows])
    assert [i for i, _ in left("near duplicates")] == sorted(min(i for (i, _), r in zip(rows, roots, strict=True) if r == root) for root in set(roots))
    kept = {i: k for i, _, _, _, k in plain.plain_results(spark, rows)}
    assert left("repeated passages") == sorted((i, kept[i].decode(errors="ignore")) for i, _ in rows)


def test_stages_on_awkward_and_empty_documents(spark, tmp_path):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in AWKWARD] + [(300, prose(77, 200), "en", "s", 1)]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        docs.collect()


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {"pipeline", *queries.QUERIES} <= set(names) and len(queries.QUERIES) == 10


def test_rows_that_share_an_id_do_not_crowd_out_others(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(40, 4))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, (x[0] + k * 1e-6).tolist()) for k in range(1, 31)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = sorted((r.rank, r.vec_id) for r in ann.nearest(frame, every=100).collect())
    others = sorted((math.hypot(*(x[i] - x[0])), i) for i in range(1, 40) if i != 7)
    assert got == [(1, 7), *((k + 2, i) for k, (_, i) in enumerate(others[:9]))]


def test_a_task_hands_on_the_nearest_of_all_its_blocks(monkeypatch):
    monkeypatch.setattr(ann, "EXACT", 100)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(4000, 16))
    x[500:900] = x[500]  # single precision leaves many
    x += 1000.0
    ids, asked = np.arange(4000), np.arange(0, 4000, 50)
    best = ann._Best(10)
    for i in range(0, 4000, 500):
        best.add(ids[i : i + 500], x[i : i + 500], asked, x[asked])
    assert best.rows == 10 * len(asked)
    got = {}
    for batch in best.take():
        for q, i, d in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got.setdefault(q, []).append((i, d))
    for q in asked:
        want = exact(ids, x, q, 10)
        assert [i for i, _ in got[q]] == [i for i, _ in want]
        assert np.allclose([d for _, d in got[q]], [d for _, d in want], rtol=1e-14)
