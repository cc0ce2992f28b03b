"""Prefix trie, chat format and tokenizer alignment against plain versions on awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import oracle
from tidemark.llm import alignment, chat, prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations():
    """Shared starts, copies, proper prefixes, NULLs, ties, repeated rows, marks inside texts, ids without a base."""
    rng = random.Random(5)
    said = ["hello", "", "ça va ▁ ok", "\\ <s>", "a</s>[INST] b [/INST]", "<\\s>[AND]\n\\", None, "[/INST", "x" * 3000]
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(205, 212), -7, -100, -103]:
        n = rng.choice([1, 2, 3, 8])
        rows += [(c, t, rng.choice(["user", "assistant", "user"]), said[rng.randrange(3)]) for t in range(n)]
    rows += [(300 + i, t, "user", "the same") for i in range(90) for t in range(3)]
    rows += [(400, None, None, None), (400, 1, "assistant", said[5]), (400, 1, "assistant", said[3]), (400, 0, "a\nb", said[4])]
    rows += [(401, t, "assistant" if t % 3 else "<s>", said[t % 9]) for t in range(400)]
    rows += [(402, 0, "assistant", "twice"), (402, 0, "assistant", "twice"), (403, 0, "", said[8])]
    return rows


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clashing = ("pos", "conv", "depth", "digest", "turns", "blocks", "segments", "mask", "formatted", "n_turns", "k1")
    return df.withColumns({c: F.lit(7) for c in clashing})


def digest(role, text):
    return hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    rows = set()
    for node, held in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = sorted(c for c in held if len(convs[c]) == len(node))
        rows.add(
            (
                min(held), len(node), min(members[node[:-1]]) if node else None, len(held),
                sum(len(n) == len(node) + 1 for n in below),
                sum(not any(len(m) == len(n) + 1 and m[:-1] == n for m in below) for n in below),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return rows


def built(spark, df):
    return prefix_trie.prefix_trie(
        *prefix_trie.with_shared_heads(prefix_trie.turn_digests(df, "conv_id", "turn", "role", "text"), 100, 6)
    )


def test_trie_equals_brute_force(spark):
    rows = [*conversations(), (None, 0, "user", "nobody's")]
    convs = rebuilt(rows)
    assert () in convs.values()  # a conversation without turns ends at the root
    got = built(spark, table(spark, rows)).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == trie(convs)


def test_trie_of_shuffled_joins_and_of_nothing(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    rows = conversations()[:150]
    assert set(map(tuple, built(spark, table(spark, rows)).collect())) == trie(rebuilt(rows))
    assert built(spark, table(spark, rows).where("false")).collect() == []


def test_ids_of_a_hot_sequence_are_joined_from_many_tasks(spark):
    ids = [*range(-500, 30_000, 3)]
    members = spark.createDataFrame([(c,) for c in ids], "conv long").selectExpr(
        "conv", "1L AS depth", "if(conv % 7 = 0, 5L, -6L) AS k1", "9L AS k2"
    )
    got = {r.k1: r.ends_sha256 for r in prefix_trie.end_digests(members.repartition(11)).collect()}
    for key, chosen in ((5, [c for c in ids if c % 7 == 0]), (-6, [c for c in ids if c % 7])):
        assert got[key] == hashlib.sha256(",".join(map(str, chosen)).encode()).hexdigest()


def grouped(rows):
    chats = {}
    for c, turn, role, text in rows:
        chats.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in chats.items()}


def test_chats_read_back_exactly(spark):
    rows = [*conversations(), (None, 0, "user", "nobody's")]
    made = chat.format_chats(table(spark, rows), "conv_id", "turn", "role", "text")
    got = {r.conv_id: r for r in chat.read_chats(made, "formatted", "mask").collect()}
    expected = grouped(rows)
    assert set(got) == set(expected)
    for c, turns in expected.items():
        row = got[c]
        assert [tuple(t) for t in row.turns] == turns
        assert row.learned == "".join(text for role, text in turns if role == "assistant")
        assert sum(run.chars for run in row.mask) == len(row.formatted)
        runs = sum(turns[i][0] != turns[i - 1][0] for i in range(1, len(turns))) + 1
        assert row.formatted.count("<s>") == runs == row.formatted.count("[/INST]")
        assert row.formatted.count("</s>") == 1
        place, masked = 0, []
        for run in row.mask:
            masked += [row.formatted[place : place + run.chars]] * run.loss
            place += run.chars
        assert len("".join(masked)) >= len(row.learned)


def test_chat_of_one_block_is_marked_as_documented(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b<s>"), (1, 2, "assistant", "c\\")]
    row = chat.format_chats(table(spark, rows), "conv_id", "turn", "role", "text").collect()[0]
    assert row.formatted == "<s>user[INST]a[AND]b<\\s>[/INST]<s>assistant[INST]c\\\\[/INST]</s>"
    assert [r.chars for r in row.mask if r.loss] == [3]


def test_a_mask_that_does_not_fit_is_an_error(spark):
    made = chat.format_chats(table(spark, conversations()[:9]), "conv_id", "turn", "role", "text")
    wrong = made.withColumn("formatted", F.replace("formatted", F.lit("[/INST]"), F.lit("!")))
    with pytest.raises(Exception, match="mask does not fit"):
        chat.read_chats(wrong, "formatted", "mask").collect()


def test_chats_of_nothing(spark):
    made = chat.format_chats(table(spark, conversations()).where("false"), "conv_id", "turn", "role", "text")
    assert chat.read_chats(made, "formatted", "mask").collect() == []


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_chat_format"])
def test_conversation_queries_equal_their_sql(spark, tmp_path, name):
    spark.createDataFrame(conversations(), SCHEMA).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert oracle.mismatch(queries.QUERIES[name](spark, str(tmp_path)), con, queries.SQL[name]) is None


@pytest.fixture(scope="module")
def paths():
    return queries.tokenizer_path(queries.BYTEWISE), queries.tokenizer_path(queries.PIECES)


def plain_alignment(texts, paths):
    """Tokens, groups and links by walking both lists of ends byte by byte."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b, chars = SentencePieceProcessor(model_file=paths[1]), alignment.byte_level()
    rows, counts = [], {}
    for text in texts:
        empty = (0, 0, 0, [], "")
        if not text:
            rows.append(empty)
            continue
        x = a.encode(" " + text, add_special_tokens=False)
        own_a, y = x.ids, b.encode(text)
        raw_a = [bytes(chars[c] for c in t) for t in x.tokens]
        raw_b = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                 for i, p in ((i, b.id_to_piece(i)) for i in y)]
        whole = (" " + text).encode()
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            rows.append(empty)
            continue
        owner_a = [i for i, t in enumerate(raw_a) for _ in t]
        owner_b = [i for i, t in enumerate(raw_b) for _ in t]
        met = sorted(set(zip(owner_a, owner_b)))
        links = [(own_a[i], y[j]) for i, j in met]
        groups, at, own = [], 0, ([], [])
        for place in range(len(whole)):
            ends = [place + 1 == len(whole) or o[place] != o[place + 1] for o in (owner_a, owner_b)]
            for side, (end, o, ids) in enumerate(zip(ends, (owner_a, owner_b), (own_a, y))):
                if end:
                    own[side].append(str(ids[o[place]]))
            if all(ends):
                groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
                own = ([], [])
        for pair in links:
            counts[pair] = counts.get(pair, 0) + 1
        rows.append((len(own_a), len(y), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    return [
        (na, nb, ng, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), sha)
        for na, nb, ng, links, sha in rows
    ]


AWKWARD = ["<|endoftext|> and </s> <s> <unk>", "  two  spaces\t\n\n end ", "▁ mark", "漢字 é́ 🙂🙂 ﷽", "\x00\x01 a", "'s 'll  x's", " ", "1234567 89"]


def test_alignment_equals_a_walk_over_bytes(spark, docs, paths):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumns({c: F.lit(7) for c in ("slice", "links", "pairs", "place", "a", "b", "times", "n_a", "_text")})
    got = alignment.alignments(df, "text", paths, [F.col("doc_id")], "doc_id long").collect()
    expected = [(i, *r) for (i, _), r in zip(rows, plain_alignment([t for _, t in rows], paths))]
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected, key=key)


def test_long_texts_go_part_by_part(docs, paths, monkeypatch):
    texts = [t for t in [r.text for r in docs.select("text").collect()] + AWKWARD if t and len(t) < 5000]
    tools = alignment.Tokenizers.load(*paths)
    whole = [alignment.rows_of(pa.array([t]), tools)[0] for t in texts]
    together = alignment.rows_of(pa.array(texts), tools)
    monkeypatch.setattr(alignment, "SLICE", 7)
    in_parts = [alignment.rows_of(pa.array([t]), tools)[0] for t in texts]
    for x, y, z in zip(whole, together, in_parts, strict=True):
        assert str(x) == str(y) == str(z)
    assert len(list(alignment.cut(texts[0]))) > 5 and any(r.n_groups for r in whole)


def test_units_of_several_slices_are_encoded_once(docs, paths, monkeypatch):
    tools, asked, encode = alignment.Tokenizers.load(*paths), [], alignment.Tokenizers.encode
    monkeypatch.setattr(
        alignment.Tokenizers, "encode", lambda self, units: asked.append(units.to_pylist()) or encode(self, units)
    )
    first, second = pa.array(["one two three", "two"]), pa.array(["three four one"])
    found = [alignment.rows_of(s, tools)[0] for s in (first, second, second)]
    assert asked == [["one", "two", "three"], ["four"]] and str(found[1]) == str(found[2])
    # However few are kept, rows stay the same: all are forgotten, or those that came once, or none.
    texts = [t for t in [r.text for r in docs.select("text").collect()] + AWKWARD + ["one \ufffd\u0000 two"] if t]
    rows = {}
    for known in (0, 40, 1 << 20):
        monkeypatch.setattr(alignment, "KNOWN", known)
        tools = alignment.Tokenizers.load(*paths)
        rows[known] = [str(alignment.rows_of(pa.array(texts[i : i + 3]), tools)) for i in range(0, len(texts), 3)]
    apart = [str(alignment.rows_of(pa.array(texts[i : i + 3]), alignment.Tokenizers.load(*paths))) for i in (0, 30)]
    assert rows[0] == rows[40] == rows[1 << 20] and [rows[0][0], rows[0][10]] == apart


@pytest.mark.parametrize("space", ["\u00a0", "\u0085", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\x1c", "\n"])
def test_units_keep_wider_white_space_together(space):
    texts = [f"a {space}b c", f"a{space} b c", f"é {space} é è", "", " ", "x", " a b "]
    units, counts = alignment.units_of(pa.array(texts))
    assert units.to_pylist() == [f"a {space}b", "c", f"a{space} b", "c", f"é {space} é", "è", " ", "x", " a", "b "]
    assert counts.tolist() == [2, 2, 2, 0, 1, 1, 2]


def test_alignment_lists_of_many_slices(spark, docs, paths, monkeypatch):
    columns = [F.col("doc_id")], "doc_id long"
    once = alignment.alignments(docs, "text", paths, *columns).collect()
    monkeypatch.setattr(alignment, "LISTED", 500)
    monkeypatch.setattr(alignment, "SLICE", 300)
    again = alignment.alignments(docs.repartition(5), "text", paths, *columns).collect()
    assert sorted(map(str, once)) == sorted(map(str, again))


def test_alignment_of_nothing(spark, no_docs, paths):
    assert alignment.alignments(no_docs, "text", paths, [F.col("doc_id")], "doc_id long").collect() == []


def test_gallop_finds_first_place_not_below():
    rng = np.random.default_rng(2)
    for _ in range(200):
        ends = np.unique(rng.integers(0, 400, rng.integers(1, 60)))
        wanted = rng.integers(-3, ends[-1] + 1, 50)
        start = rng.integers(0, len(ends), 50)
        assert np.array_equal(alignment.gallop(wanted, ends, start), np.searchsorted(ends, wanted))


def test_alignment_query_columns(spark, paths):
    got = queries.QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001")
    rows = {r.doc_id: tuple(r)[1:] for r in got.collect()}
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert rows == {r.doc_id: row for r, row in zip(given, plain_alignment([r.text for r in given], paths))}
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert dict(got.dtypes)["count_sum"] == "bigint"
