"""The pipeline's stages one after the other, each against a version in plain Python of what it should keep."""

from collections import defaultdict

import corpus_pipeline
from reelforge.llm import language, lines, mixing

from .test_corpus_operators import by_brute_force, exact_languages
from .test_exact_and_lines import edit_distance
from .test_mixing import brute_force as mixed_by_brute_force


def ids_and_texts(frame):
    return sorted((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())


def without_lines(rows):
    seen, kept = {}, []
    for doc_id, text in rows:
        left, cut = [], False
        for line in text.split("\n"):
            plain = line.strip(" ")
            if len(plain) >= lines.LEAST_CHARS:
                known = plain in seen
                if not known:
                    seen[plain] = any(abs(len(o) - len(plain)) <= 1 and (len(o) != len(plain) or sum(x != y for x, y in zip(o, plain)) <= 1)
                                      and edit_distance(o, plain) <= 1 for o in seen)
                if known or seen[plain]:
                    cut = True
                    continue
            left.append(line)
        if not cut or "\n".join(left).strip(" "):
            kept.append((doc_id, "\n".join(left)))
    return kept


def test_stages_match_brute_force(spark, corpus, small_dir):
    stages = dict(corpus_pipeline.STAGES)
    rows = sorted((r.doc_id, r.text, r.lang) for r in corpus.collect())

    known = stages["language ID"](spark, corpus, small_dir)
    expected = [(doc_id, text) for (doc_id, text, _), (lang, share, _) in zip(rows, exact_languages(rows)) if lang != "und" and share >= language.LEAST_SCORE]
    assert ids_and_texts(known) == expected and len(expected) >= 0.95 * len(rows)  # clean documents stay

    fresh = stages["line dedup"](spark, known, small_dir)
    expected = without_lines(expected)
    assert ids_and_texts(fresh) == expected

    single = stages["n-gram Jaccard join"](spark, fresh, small_dir)
    _, roots = by_brute_force(expected)
    expected = [row for at, row in enumerate(expected) if roots[at] == at]
    assert ids_and_texts(single) == expected

    mixed = stages["source mixing"](spark, single, small_dir)
    named = {r.doc_id: r.source for r in corpus.collect()}
    targets = {r.source: (r.sid, r.blocks, r.slots) for r in mixing.source_targets(mixing.sized_rows(single)).collect()}
    taken = {doc_id: words for doc_id, _, words, _ in mixed_by_brute_force([(i, t, named[i]) for i, t in expected], targets)}
    found, whole = defaultdict(int), dict(expected)
    for doc_id, text in ids_and_texts(mixed):
        found[doc_id] += len(text.split())
        assert text == whole[doc_id] or set(text.split()) <= set(whole[doc_id].split())
    assert dict(found) == {doc_id: words for doc_id, words in taken.items() if words}

    pieces, filled = defaultdict(int), defaultdict(list)
    for r in stages["best-fit packing"](spark, mixed, small_dir).collect():
        pieces[r.doc_id] += 1
        filled[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(found)
    for parts in filled.values():  # gapless from 0, never too long
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(filled) <= 1.02 * sum(length for parts in filled.values() for _, length in parts) / 4096 + 1
