"""Token alignment, conversation tries and near vectors, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as driver
from check_oracle import compare, duck
from saleslake.llm import conversation_trie, near_vectors, ngram_join, token_align

SF_DIR = "/root/testdata/sf0.001"
FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")

# --- alignment -----------------------------------------------------------------------------


def byte_pieces():
    """The bytes of every entry of the byte-level vocabulary."""
    tokenizer = Tokenizer.from_file(FIRST)
    tokenizer.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    return tokenizer, {
        at: bytes(letters[c] for c in piece)
        for piece, at in tokenizer.get_vocab(with_added_tokens=False).items()
        if all(c in letters for c in piece)
    }


def merged(a, b):
    """Groups and links of two rows of (id, bytes), walked side by side."""
    groups, links, own = [], [], ([], [])
    p = q = end_a = end_b = 0
    end_a, end_b = len(a[0][1]), len(b[0][1])
    while p < len(a) and q < len(b):
        links.append((a[p][0], b[q][0]))
        if end_a <= end_b:
            own[0].append(a[p][0])
        if end_b <= end_a:
            own[1].append(b[q][0])
        if end_a == end_b:
            groups.append(own)
            own = ([], [])
        step_a, step_b = end_a <= end_b, end_b <= end_a
        p, q = p + step_a, q + step_b
        end_a += len(a[p][1]) if step_a and p < len(a) else 0
        end_b += len(b[q][1]) if step_b and q < len(b) else 0
    return groups, links


def brute_alignment(rows):
    tokenizer, known = byte_pieces()
    model = SentencePieceProcessor(model_file=SECOND)

    def piece(at):
        name = model.id_to_piece(at)
        return bytes([int(name[3:5], 16)]) if model.is_byte(at) else name.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for one, text in rows:
        raw = (" " + (text or "")).encode()
        a = [(x, known.get(x, b"")) for x in tokenizer.encode(raw.decode(), add_special_tokens=False).ids]
        b = [(x, piece(x)) for x in model.encode(text or "")]
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            docs.append((one, 0, 0, [], []))
            continue
        groups, links = merged(a, b)
        counts.update(links)
        docs.append((one, len(a), len(b), groups, links))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for one, n_a, n_b, groups, links in docs:
        spelled = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((
            one, n_a, n_b, len(groups), len(links),
            sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(spelled.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def odd_texts():
    r = random.Random(3)
    return [
        "", None, " ", "a", "  b", "a▁b", "<s>x</s>", "<|endoftext|> hi", "日本語テキスト🙂",
        "\x00\x01", "x\n\n\ty", "é" * 400, "<0x41>", "ﬁ", "á", "trail  ", "　wide",
        "the same", "the same", "word " * 30_000, "x" * 5_000,
        "".join(chr(r.randrange(1, 0xD7FF)) for _ in range(500)),
        *("".join(r.choices("ab \n.é日1'", k=r.randrange(60))) for _ in range(100)),
    ]


def test_alignment_of_odd_texts(spark):
    rows = list(enumerate(odd_texts())) + [(0, "an id again"), (None, "no id")]
    docs = spark.createDataFrame(
        [(i, t, "x", 1, 2) for i, t in rows],
        "doc_id long, text string, block string, pairs int, count int",
    ).repartition(3)
    ours = token_align.align_tokens(docs, FIRST, SECOND, block_tokens=500).select(*ALIGNED)
    assert sorted(map(tuple, ours.collect()), key=str) == brute_alignment(rows)
    assert token_align.align_tokens(docs.limit(0), FIRST, SECOND).collect() == []


def test_alignment_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    ours = driver.queries()["op11_cross_tokenizer_alignment"](spark, SF_DIR).select(*ALIGNED)
    assert sorted(map(tuple, ours.collect()), key=str) == brute_alignment(docs.collect())


def test_shared_cuts_of_any_ends():
    r = np.random.Generator(np.random.PCG64(1))
    for _ in range(300):
        size = int(r.integers(1, 80))
        a, b = (
            np.unique(np.append(r.integers(1, size + 1, int(r.integers(0, size + 1))), size))
            for _ in range(2)
        )
        assert a[token_align.shared_cuts(a, b)].tolist() == np.intersect1d(a, b).tolist()


# --- tries ---------------------------------------------------------------------------------


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        if conv is not None:
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(role, text) for _, role, _, text in sorted(v)] for c, v in turns.items()}
    members, ends, children = defaultdict(list), defaultdict(list), Counter()
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])
        whole = tuple(base[:h] + own[c][h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    leaves, saved = Counter(), Counter()
    for node in members:
        children[node[:-1]] += bool(node)
    for node, inside in members.items():
        words = [w for w in re.split("[ \t\n\x0b\f\r]+", node[-1][1]) if w] if node else []
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(inside) - 1) * len(words)
            leaves[node[:d]] += not children[node]
    return sorted(
        (
            inside[0], len(node), members[node[:-1]][0] if node else None, len(inside),
            children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, inside in members.items()
    )


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256")


def conversation_rows():
    """A long conversation with ties, families that share beginnings, copies, odd ids."""
    r = random.Random(5)
    said = ["a b", "c", None, "", "x\ty z"]
    rows = [
        (20, k if r.random() < 0.9 else None, r.choice(["user", None, "bot"]), r.choice(said))
        for k in range(200)
    ]
    rows += [
        (c, k, "user", f"turn {k} {'z' * (k > 3 and c % 3)}")
        for c in range(40, 140) if c != 80 for k in range(r.randrange(1, 7))
    ]
    rows += [(c, k, "u", "s") for c in (-25, -20, -3, 0, 7) for k in (None, None, 1, 2)]
    rows += [(None, 1, "a", "b"), (1000, 1, "u", "long " * 50_000)]
    r.shuffle(rows)
    return rows


def test_trie_over_many_tasks(spark, conf):
    # without merging, the long conversation lies in several tasks
    conf(spark__sql__adaptive__coalescePartitions__enabled="false",
         spark__sql__shuffle__partitions="7")
    rows = conversation_rows()
    table = spark.createDataFrame(
        [(*row, "x", 1, 2) for row in rows],
        "conv_id long, turn int, role string, text string, conv string, depth int, words int",
    ).repartition(3)
    ours = conversation_trie.prefix_trie(table).select(*TRIE).collect()
    assert sorted(map(tuple, ours)) == brute_trie(rows)
    assert conversation_trie.prefix_trie(table.limit(0)).collect() == []


def test_trie_with_colliding_fingerprints(spark, monkeypatch):
    """With a base of 1 two turns in either order have one fingerprint; another base follows."""
    rows = [(1, 0, "u", "p"), (1, 1, "u", "q"), (22, 0, "u", "q"), (22, 1, "u", "p")]
    rows += [(c, k, "u", t) for c in (200, 220, 240) for k, t in enumerate("qprqp")]
    rows += [(c, k, "u", t) for c in (300, 320, 340) for k, t in enumerate("pqrpq")]
    real, asked = conversation_trie._bases, []

    def bases(seed):
        asked.append(seed)
        return (1, 1) if seed == 0 else real(seed)

    monkeypatch.setattr(conversation_trie, "_bases", bases)
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    ours = conversation_trie.prefix_trie(table).select(*TRIE).collect()
    assert sorted(map(tuple, ours)) == brute_trie(rows)
    assert asked == [0, 1]


def test_ids_of_a_node_are_hashed_over_batches(spark, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="7")
    rows = [(c, 0, "u", "same") for c in range(0, 4000, 20)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    ours = conversation_trie.prefix_trie(table).select(*TRIE).collect()
    assert sorted(map(tuple, ours)) == brute_trie(rows)


# --- near vectors --------------------------------------------------------------------------


def brute_near(rows, least=0.98):
    """(id, links, component, kept) of rows (id, vector, label)."""
    whole = [
        one is not None and label is not None and bool(vector) and any(vector)
        and all(x is not None and np.isfinite(x) for x in vector)
        for one, vector, label in rows
    ]
    links, root = [0] * len(rows), {one: one for one, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (one, v, label) in enumerate(rows):
        for j, (other, w, name) in enumerate(rows[:i]):
            if whole[i] and whole[j] and label == name and len(v) == len(w):
                x, y = (np.array(z, dtype=float) / max(map(abs, z)) for z in (v, w))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[i] += 1
                    links[j] += 1
                    a, b = find(one), find(other)
                    root[max(a, b)] = min(a, b)
    return sorted(
        ((one, n, None if one is None else find(one), one is not None and one == find(one))
         for (one, _, _), n in zip(rows, links, strict=True)), key=str,
    )


def vector_rows():
    """Groups about the threshold, copies, scaled copies, odd dimensions and broken vectors."""
    r = np.random.Generator(np.random.PCG64(9))
    rows = []
    for dim in (1, 3, 8, 20, 64):
        for center in r.standard_normal((3, dim)):
            for noise in (0.0, 0.05, 0.1, 0.14, 0.2):
                for _ in range(6):
                    v = center + noise * r.standard_normal(dim) * np.linalg.norm(center) / dim**0.5
                    rows.append((len(rows) * 7 % 1000, [float(x) for x in v], len(rows) % 2))
                    rows.append((5000 + len(rows), [float(x) * 3 for x in v], len(rows) % 2))
    broken = [None, [], [0.0, 0.0], [1.0, None], [1.0, float("nan")], [float("inf"), 1.0]]
    rows += [(9000 + k, v, 1) for k, v in enumerate(broken)]
    same = [float(x) for x in r.standard_normal(64)]
    rows += [(9100 + k, same, 1) for k in range(40)] + [(9100, [-x for x in same], 1)]
    rows += [(9200, same, None), (None, same, 1), (9300, [1e300, 1e300], 0), (9301, [1e-300] * 2, 0)]
    return rows


def test_near_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "CHUNK", 8)
    rows = vector_rows()
    table = spark.createDataFrame(
        [(*row, 1, "x", 2.0) for row in rows],
        "vec_id long, embedding array<double>, label int, cid int, unit string, links double",
    ).repartition(3)
    ours = near_vectors.near_duplicates(table)
    assert ours.columns == ["id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, ours.collect()), key=str) == brute_near(rows)
    assert near_vectors.near_duplicates(table.limit(0)).collect() == []


def test_no_candidate_is_lost_without_units(spark, monkeypatch):
    """Each vector a unit of its own: all links come from the blocks' range joins."""
    monkeypatch.setattr(
        near_vectors, "_units", lambda classes, least: classes.withColumn("unit", classes["cid"])
    )
    rows = vector_rows()[:400]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    ours = near_vectors.near_duplicates(table).collect()
    assert sorted(map(tuple, ours), key=str) == brute_near(rows)


def test_large_groups_make_few_rows(spark):
    """A group's rows to verify with are as many as its texts and chunks, not as its pairs."""
    r = np.random.Generator(np.random.PCG64(2))
    size = 3 * near_vectors.CHUNK
    vectors = r.standard_normal(64) + 0.05 * r.standard_normal((size, 64))
    table = spark.createDataFrame(
        [(k, v.tolist(), 1) for k, v in enumerate(vectors)],
        "vec_id long, embedding array<double>, label int",
    )
    made, real = [], near_vectors.stored

    def seen(df, purpose):
        out = real(df, purpose)
        if purpose in ("vector-candidates", "vector-links"):
            made.append(out.count())
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(near_vectors, "stored", seen)
        ours = near_vectors.near_duplicates(table).collect()
    assert {(x.component_id, x.n_links) for x in ours} == {(0, size - 1)}
    assert sum(made) <= 5 * size


@pytest.mark.parametrize("name", ["op12_conversation_prefix_trie", "op13_embedding_near_dedup"])
def test_same_as_sql(spark, name):
    assert compare(spark, duck(SF_DIR), name, SF_DIR) == ""


# --- near copies below the threshold -------------------------------------------------------


def test_near_copies_that_do_not_link_make_few_rows(spark):
    """A group whose texts are mostly too different for links: pairs of units, not of texts."""
    r = random.Random(8)
    base = [f"w{k}" for k in range(300)]

    def rows_of(size):
        texts = []
        for _ in range(size):
            words = base[:]
            for at in r.sample(range(300), 8):  # each changes five shingles
                words[at] = f"v{r.randrange(10**6)}"
            texts.append(" ".join(words))
        table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        made, real = [], ngram_join.stored

        def seen(df, purpose):
            out = real(df, purpose)
            if purpose in ("ngram-pairs", "ngram-across", "ngram-edges"):
                made.append(out.count())
            return out

        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(ngram_join, "stored", seen)
            ours = ngram_join.similar_components(table).collect()
        return sum(made), sorted(tuple(row) for row in ours), texts

    few, _, _ = rows_of(150)
    many, ours, texts = rows_of(300)
    assert few < 5 * 150 and many < 5 * 300  # of 11,175 and 44,850 pairs
    sets = [{tuple(t.split()[k : k + 5]) for k in range(296)} for t in texts]
    root = list(range(300))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(300):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert ours == [(k, len(sets[k]), find(k)) for k in range(300)]
