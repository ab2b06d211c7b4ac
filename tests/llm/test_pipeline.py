"""The pipeline's stages, each on what the one before it kept, and its rows by plain Python."""

import collections
import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from brightvault.llm import quality
from tests.llm.test_simhash import slow_components, slow_print
from tests.llm.test_text_operators import water

DIR = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"


def split(text):
    for c in BLANKS:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def without_boilerplate(rows):
    sites, texts = collections.defaultdict(set), collections.defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            sites[line.strip(BLANKS)].add(r["source"])
            texts[line.strip(BLANKS)].add(r["text"])
    bad = {x for x in sites if len(split(x)) >= 3 and len(sites[x]) >= 10 and len(texts[x]) >= 10}
    for r in rows:
        text = None if r["text"] is None else "\n".join(x for x in r["text"].split("\n") if x.strip(BLANKS) not in bad)
        yield r | {"text": text, "n_chars": None if text is None else len(text)}


def one_of_each(rows):
    prints = [(r["doc_id"], slow_print(r["text"])) for r in rows]
    least = slow_components(prints)
    return [r for r, (d, p) in zip(rows, prints) if least[p] == d]


def mixed(rows):
    names = sorted({r["source"] for r in rows if r["source"] is not None}) + [None] * any(r["source"] is None for r in rows)
    own = [[(int(hashlib.md5(f"{r['doc_id']}:{r['text'] or ''}".encode()).hexdigest()[:15], 16), len(split(r["text"] or "")), r) for r in rows if r["source"] == n] for n in names]
    sizes = [sum(n for _, n, _ in o) for o in own]
    for of, size, target in zip(own, sizes, water(sizes, [(1, 2, 3)[i % 3] for i in range(len(names))]), strict=True):
        base = int(target // size) if size else 0
        before, rest = 0, target - base * size
        for _, n, r in sorted(of, key=lambda x: x[:2]):
            yield from [r] * (base + (2 * before + n < 2 * rest))
            before += n


def test_rows_by_plain_python(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    rows = [r.asDict() for r in docs.collect() if model.score(quality.features(r.text)) >= 0.7]
    assert 0 < len(rows) < docs.count()
    rows = list(mixed(one_of_each(list(without_boilerplate(rows)))))
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lib.no_truncation(), lib.no_padding()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    ids = {r["doc_id"]: lib.encode(r["text"] or "", add_special_tokens=False).ids for r in rows}
    want = [(d, len(ids[d]), sha(",".join(map(str, ids[d]))), sha(lib.decode(ids[d], skip_special_tokens=False))) for d in (r["doc_id"] for r in rows)]
    got = corpus_pipeline.run(spark, DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DIR).columns == docs.columns, name
