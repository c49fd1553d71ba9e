import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bramble.llm import html_extract, packing, sentencepiece_codec
from conftest import SF_MID
from helpers import documents, odd_rows
from oracle_harness import duck


# ---- HTML

def text(html, low=()):
    return html_extract.page_text(html, set(low))


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"),
    ("<article><h1>A&nbsp;b</h1><p>One\n two<p>Three<br>four</article>", "A b\nOne two\nThree four"),
    ("<nav>menu</nav><header>top</header><article><header><h1>T</h1></header><p>x <b>y</b></p></article><footer>f</footer>", "T\nx y"),
    ("<body><div class='site-sidebar'>s</div><div id=comments><p>c</p></div><main><p>m</p><aside>a</aside></main>", "m"),
    ("<article class='post with-sidebar'><p>kept</p><section class='reader-comments'><p>no</p></section></article>", "kept"),
    ("<article><p>a</p><script>if (1 < 2) '</p>'</script><style>p{}</style><!-- <p>no</p> --><p>b", "a\nb"),
    ("<p>a<form><p>f</p></form><div class=adBox>x</div><div role=navigation>n</div><p hidden>h</p><p>b</p>", "a\nb"),
    ("<article><p><b>bold<br><p>next</p><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "bold\nnext\none\ntwo\nc1\nc2"),
    ("<article>&#233;&eacute;&lt;p&gt; 1 < 2 <3 </article>", "éé<p> 1 < 2 <3"),
    ("<article><p title=\"a > b\">q</p><p title='x'y>r</p><p", "q\nr"),
    ("<script>never closed <p>x", ""), ("</p></div>a</b>", "a"),
])
def test_page_text(html, want):
    assert text(html) == want


def test_style_tree_removes_what_a_site_repeats(spark):
    rows = [(i, "http://site.example/%d" % i, f"<div><p class=lead>Same words on all pages</p><p>own text {i}</p><p>more {i * 7} text</p></div>")
            for i in range(20)]
    rows += [(100 + i, "http://other.example/%d" % i, "<article><h1>Copy</h1><p>the same page again</p></article>") for i in range(20)]
    rows += [(200 + i, "http://one.example", "<p>only</p>") for i in range(2)] + [(300, None, None), (301, "", "x"), (None, "::bad", "<p>y")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string")
    got = html_extract.extract(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[3] == "own text 3\nmore 21 text"
    assert by_id[105] == "Copy\nthe same page again"  # a host of copies keeps its text
    assert by_id[200] == "only" and by_id[300] == "" and by_id[301] == "x" and by_id[None] == "y"
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_extract_keeps_whole_articles(spark):
    pages = duck(SF_MID).execute("select page_id, html from pages").fetchall()
    got = {r.page_id: r.text for r in html_extract.extract(spark.read.parquet(f"{SF_MID}/pages.parquet")).collect()}
    import html as entities
    import re
    for i, h in pages:
        body = h[h.index("<article>"):].split("</article>")[0].split("<footer>")[0]
        parts = (re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", " ", x))).strip() for x in re.split(r"</?(?:p|h1|article)>", body))
        assert got[i] == "\n".join(x for x in parts if x)


# ---- packing

def test_tournament_finds_the_first_bin():
    rng = random.Random(2)
    tree, room = packing.Tournament(50, 100), [100] * 50
    for _ in range(120):
        size = rng.randrange(1, 30)
        want = next((i for i, r in enumerate(room) if r >= size), None)
        if want is None:
            break
        room[want] -= size
        assert tree.place(size) == want


@pytest.mark.parametrize("seed", range(6))
def test_pack_group_covers_every_token_once(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, rng.randrange(1, 40), rng.randrange(1, 3000), 1024, 2048]) for _ in range(rng.randrange(1, 200))]
    sequences = packing.pack_group(lengths)
    seen = [[0] * n for n in lengths]
    sizes = []
    for s in sequences:
        for p in s:
            for k in range(p.start, p.start + p.length):
                seen[p.doc][k] += 1
        sizes.append(sum(p.length for p in s))
    assert all(c == 1 for s in seen for c in s)
    assert all(n & (n - 1) == 0 for n in sizes) and max(sizes) <= 1024  # full or a power of two: no padding


def check_pieces(rows, got, encode):
    texts = {}
    for d, t in rows:
        texts.setdefault(d, set()).add(t or "")
    made = {t: np.array(encode(t) + [0], "<u4") for own in texts.values() for t in own}
    sequences, total = {}, 0
    for r in got:
        options = [made[t] for t in texts[r.doc_id]]
        assert any(len(a) == r.doc_tokens and zlib.crc32(a[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for a in options)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total += r.length
    assert total == sum(len(encode(t or "")) + 1 for _, t in rows)
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= 1024 and at & (at - 1) == 0


def test_pack_odd_rows_and_small_groups(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = odd_rows() + [(50, "a <|endoftext|> b<|endoftext|>"), (51, "x" * 3000)]
    encode = lambda s: t.encode(s, add_special_tokens=False).ids
    for group_docs, group_tokens in ((512, 1 << 22), (2, 4000)):
        got = packing.pack(documents(spark, rows), group_docs=group_docs, group_tokens=group_tokens).collect()
        check_pieces(rows, got, encode)
    assert packing.pack(documents(spark, rows).limit(0)).count() == 0


def test_token_ids_equal_the_other_reader():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fast = packing.tokenizer()
    texts = [x for x, in duck(SF_MID).execute("select text from documents limit 200").fetchall()]
    texts += ["", " ", "\n\n x", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "<|endoftext", "don't 漢字   🙂", "1234567 a\r\n\tb  c   "]
    for x in texts:
        assert fast.encode(x, allowed_special="all") == t.encode(x, add_special_tokens=False).ids


# ---- SentencePiece

@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec()


def best_score(codec, s, scores):
    best = [0.0] + [float("-inf")] * len(s)
    for e in range(1, len(s) + 1):
        if s[e - 1] not in codec.single:
            best[e] = best[e - 1] + codec.unknown
        for n in range(1, e + 1):
            if s[e - n:e] in scores:
                best[e] = max(best[e], best[e - n] + scores[s[e - n:e]])
    return best[-1]


def test_viterbi_equals_brute_force(codec):
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    scores = {m.id_to_piece(i): m.get_score(i) for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))}
    texts = [x[:200] for x, in duck(SF_MID).execute("select text from documents limit 60").fetchall()]
    for x in [*texts, "  two  blanks ", "漢字かな🙂 x", "a\tb\nc"]:
        ids = codec.encode(x)
        s = sentencepiece_codec.BLANK + x.replace(" ", sentencepiece_codec.BLANK)
        total = sum(m.get_score(i) for i in ids if not m.is_byte(i)) + codec.unknown * sum(c not in codec.single for c in s)
        assert abs(total - best_score(codec, s, scores)) < 1e-6


def test_round_trip(codec, spark):
    for x in ("", " ", "▁", "a▁ ▁b", "\u0000", "🙂🙂", "  lead and trail  ", "漢字", "￿"):
        assert codec.decode(codec.encode(x)) == x
    docs = documents(spark, odd_rows())
    got = sentencepiece_codec.round_trip(docs).collect()
    assert len(got) == len(odd_rows()) and all(r.same for r in got)
    assert {r.doc_id: r.n_ids for r in got}[2] == 0
    assert sentencepiece_codec.round_trip(docs.limit(0)).count() == 0
    assert all(r.same for r in sentencepiece_codec.round_trip(spark.read.parquet(f"{SF_MID}/documents.parquet")).collect())
