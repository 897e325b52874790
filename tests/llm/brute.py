"""Plain versions of the contracts, one row at a time, for tests."""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum(text):
    return ALNUM.findall(lower(text))


@lru_cache(1)
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text, end):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def op1_pieces(docs):
    """(doc_id, piece, start, length, crc) of each piece."""
    out = []
    for doc_id, text in docs:
        ids = ids_of(text, 2)
        first = len(ids) % 1024 or min(1024, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((doc_id, k, a, b - a, crc(ids[a:b])))
    return out


def op2(docs):
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = ids_of(text, 0)
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def jump(key, shards):
    key &= (1 << 64) - 1
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        ahead = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def op9(docs):
    """Without the slot."""
    return [
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", jump(d or 0, 8), jump(d or 0, 9))
        for d, t in docs
    ]


def op10(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        words, hit, found = alnum(text), set(), set()
        for item_id, item in items:
            part = alnum(item)
            n = min(window, len(part))
            for i in range(len(part) - n + 1 if n else 0):
                for j in range(len(words) - n + 1):
                    if words[j : j + n] == part[i : i + n]:
                        hit.update(range(j, j + n))
                        if item_id is not None:
                            found.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return out


def op3(pages):
    first = {}
    for page_id, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        keeper = first.get(data)
        revisit = keeper is not None and keeper != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return out


def op4_base(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(grams) < 3000 else None
    if covered is None:
        counts = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    n = len(words)
    return n, sum(map(len, words)), symbols, dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def normal_lines(text):
    """The lines with a word: A-Z in lower case, words joined by single spaces."""
    return [" ".join(words) for line in (text or "").split("\n") if (words := WORD.findall(lower(line)))]


def boilerplate(docs, host_of, share, least):
    """{(host, line)} above the limit by the rule alone: documents of a host are distinct if their sets of lines are, and
    a line may stand in ``share`` of those, or in ``least``. No sketches, and near copies are documents of their own."""
    texts = {}
    for doc_id, text in docs:
        texts.setdefault(host_of(doc_id), set()).add(frozenset(normal_lines(text)))
    out = set()
    for host, distinct in texts.items():
        distinct.discard(frozenset())
        counts = Counter(line for lines in distinct for line in lines)
        out |= {(host, line) for line, n in counts.items() if n > max(least, share * len(distinct))}
    return out


def op4(docs, host_of, share, least, left_words, left_share):
    """(doc_id, base..., kept)."""
    above, out = boilerplate(docs, host_of, share, least), []
    for doc_id, text in docs:
        base = op4_base(text)
        gone = sum(len(line.split(" ")) for line in normal_lines(text) if (host_of(doc_id), line) in above)
        left = base[0] - gone
        depleted = gone > 0 and (left < left_words or left < left_share * base[0])
        out.append((doc_id, *base, not base[-1] and not depleted))
    return out


def sentences(text):
    """(words, start, end) of each unit: lines, cut at white space after a sentence's end, or before a capital that follows a
    lower-case letter, a number or one of ``,;:``."""
    out, start, i = [], 0, 0
    while i <= len(text):
        j = i
        while j < len(text) and text[j] != "\n" and text[j].isspace():
            j += 1
        before, behind = text[i - 1 : i], text[j : j + 1]
        kind = [unicodedata.category(c) if c else "" for c in (before, behind)]
        stop = before and before in ".!?…。"
        capital = (kind[0] == "Ll" or kind[0][:1] == "N" or (before and before in ",;:")) and kind[1] == "Lu"
        if i == len(text) or text[i] == "\n" or (j > i and (stop or capital)):
            if words := alnum(text[start:i]):
                out.append((tuple(words), start, i))
            start = i = max(j, i + 1)
        else:
            i = max(j, i + 1)
    return out


def op5(docs, min_words):
    """(doc_id, spans, text) of each row: runs of units that stood in an earlier place, if they have words enough, are cut out."""
    first, out = {}, {}
    for i in sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i)):
        doc_id, text = docs[i]
        run, spans = [], []
        for unit in [*sentences(text or ""), None]:
            if unit and unit[0] in first:
                run.append(unit)
                continue
            if (n := sum(len(u[0]) for u in run)) >= min_words:
                spans.append((run[0][1], run[-1][2], len(run), n, first[run[0][0]]))
            run = []
            if unit:
                first[unit[0]] = doc_id
        left = text
        for a, b, *_ in reversed(spans):
            one_space = b < len(text) and text[b].isspace() and (a == 0 or text[a - 1].isspace())
            left = left[:a] + left[b + one_space :]
        out[i] = (doc_id, spans, left)
    return [out[i] for i in range(len(docs))]


def op6_base(text, phrases):
    words, places = alnum(text), []
    for phrase, label in phrases.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, x in places})


def blocks(text, reach):
    """The distinct words of each line with those that follow it in its paragraph, until those that follow are ``reach``."""
    lines = [alnum(line) for line in (text or "").split("\n")]
    for i, line in enumerate(lines):
        if line:
            behind, j = [], i + 1
            while len(behind) < reach and j < len(lines) and lines[j]:
                behind += lines[j]
                j += 1
            yield {*line, *behind}


def op6(docs, phrases, templates, threshold):
    out = []
    for doc_id, text in docs:
        *base, labels = op6_base(text, phrases)
        best, every = (1.0 if labels else 0.0), set(labels)
        reach = max((len(alnum(t)) for _, t in templates), default=0)
        for words in blocks(text, reach):
            for label, template in templates:
                asked = set(alnum(template))
                if len(asked & words) >= threshold * len(asked) - 1e-9:
                    every.add(label)
                    best = max(best, len(asked & words) / len(asked))
        out.append((doc_id, *base, ",".join(labels), ",".join(sorted(every)), best))
    return out


def fingerprint(text, width=4):
    import xxhash

    words = WORD.findall(lower(text))
    grams = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def op7(docs, threshold=4):
    prints = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= threshold:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(docs, prints))]


def op8(docs, learn):
    """Scores with weights from ``learn(events, n_counted, v_counted)``; events as in the operator."""
    import math
    from collections import Counter

    def part(doc_id):
        fold = None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7
        return {2: 2, 3: 1}.get(fold, 0)

    streams = [(d, part(d), [*WORD.findall(lower(t)), None]) for d, t in docs]
    words, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for _, p, tokens in streams:
        if p < 2:
            words[p].update(tokens)
            pairs[p].update(zip([None, *tokens], tokens))
    events = Counter()
    for (v, w), n in pairs[1].items():
        events[pairs[0][v, w], words[0][v], words[0][w]] += n
    table = learn(events, words[0].total(), len(words[0]))
    word, pair = words[0] + words[1], pairs[0] + pairs[1]
    n_tokens, n_words = word.total(), len(word)
    out = []
    for doc_id, p, tokens in streams:
        base = sum(math.log10((word[w] + 1) / (n_tokens + n_words + 1)) for w in tokens)
        score = 0.0
        for v, w in zip([None, *tokens], tokens):
            l2, l1, l0 = table[math.ceil(math.log2(word[v] + 1))]
            score += math.log10(l2 * pair[v, w] / max(word[v], 1) + l1 * word[w] / max(n_tokens, 1) + l0 / (n_words + 1))
        out.append((doc_id, p == 2, len(tokens), sum(word[w] > 0 for w in tokens), n_tokens, base, score))
    return out
