"""Token ids of a public word-level BPE vocabulary, by cached chunks.

The vocabulary's pattern never joins characters across a space or a line feed,
nor do its special tokens hold any, so the ids of a text are those of its
chunks between them, one after another. They are the tokenizer's own for the
whole text with ``add_special_tokens=False``: a special token's string in a text
is that token.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import islice

from tallyframe.llm.shared import worker_table

#: The vocabulary file that is looked up beside the installed tokenizers' list.
WORD_BPE = "word_bpe_49k.json"


@lru_cache(maxsize=2)
def _tokenizers(path: str):
    """The vocabulary's tokenizer, and its merges alone, for small ASCII letters between spaces."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    if not os.path.isabs(path):
        import public_tokenizers

        path = public_tokenizers.path(path)
    whole, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    plain.normalizer, plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
    return whole, plain


class ChunkIds:
    """Ids of texts, as unsigned 32-bit integers. Remembers about ``limit`` chunks."""

    def __init__(self, path: str, limit: int = 250_000):
        import numpy as np

        (self.whole, self.plain), self.limit, self.known = _tokenizers(path), limit, {"": b""}
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values()) + 3, bool)  # ids that end a word
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.ends = {c: self._each([c])[0] for c in ".,"}

    def _each(self, chunks: list[str]) -> list[bytes]:
        import numpy as np

        return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch_fast(chunks, add_special_tokens=False)]

    def _words(self, words: list[str], tokenizer) -> list[bytes]:
        """Chunks of letters only, which are one word each, in one call."""
        import numpy as np

        ids = np.array(tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return self._each(words)
        data, cuts = ids.tobytes(), (4 * ends).tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]

    def _learn(self, chunks: list[str]) -> None:
        """The vocabulary ignores case and splits letters from a full stop or comma after them."""
        known, ascii_words, words, others, cased, ended = self.known, set(), set(), [], [], []
        for c in chunks:
            low = c.lower()
            plain = c.isascii()
            if low.isalpha():
                (ascii_words if plain else words).add(low if plain else c)
                if plain and low != c:
                    cased.append(c)
            elif low[-1] in self.ends and low[:-1].isalpha():
                (ascii_words if plain else words).add(low[:-1] if plain else c[:-1])
                ended.append(c)
            else:
                others.append(c)
        made = ((lambda p: self._words(p, self.plain), ascii_words), (lambda p: self._words(p, self.whole), words), (self._each, others))
        for make, of in made:
            new = [c for c in of if c not in known]
            for at in range(0, len(new), 4096):
                known.update(zip(new[at : at + 4096], make(new[at : at + 4096])))
        for c in cased:
            known[c] = known[c.lower()]
        for c in ended:
            known[c] = known[c[:-1].lower() if c.isascii() else c[:-1]] + self.ends[c[-1]]

    def column(self, texts):
        """All ids of an Arrow column of texts, one text after another, and where each text begins and the last ends."""
        import numpy as np
        import pyarrow.compute as pc

        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        chunks, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        ids = list(map(self.known.get, chunks))
        new = [k for k, i in enumerate(ids) if i is None]
        if len(self.known) + len(new) > self.limit:  # what came first is mostly what is frequent
            self.known = dict(islice(self.known.items(), self.limit // 2))
        self._learn([chunks[k] for k in new])
        for k in new:
            ids[k] = self.known[chunks[k]]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        table, first = np.frombuffer(b"".join(ids), "<u4"), np.concatenate([[0], np.cumsum(sizes)])
        each = sizes[at]
        ends = np.concatenate([[0], np.cumsum(each)])
        flat = table[np.repeat(first[at] - ends[:-1], each) + np.arange(ends[-1])]
        offsets = split.offsets.to_numpy()
        return flat, ends[offsets - offsets[0]]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        import pyarrow as pa

        flat, ends = self.column(pa.array(texts, pa.string()))
        return [flat[a:b].tobytes() for a, b in zip(ends, ends[1:])]


def chunk_ids(path: str) -> ChunkIds:
    """The worker process's table."""
    return worker_table(f"chunks {path}", lambda: ChunkIds(path))


@lru_cache(maxsize=2)
def _byte_encoding(path: str):
    """The encoding of a rank file: a token and its rank in each line."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path if os.path.isabs(path) else public_tokenizers.path(path), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(path: str, texts) -> list[int]:
    """Numbers of tokens of an Arrow column of texts, by a vocabulary file: ranks (``.tiktoken``) or words (``.json``, see ``ChunkIds``)."""
    if path.endswith(".tiktoken"):
        encoding = _byte_encoding(path)
        return [len(encoding.encode_ordinary(t)) for t in texts.to_pylist()]
    _, ends = chunk_ids(path).column(texts)
    return (ends[1:] - ends[:-1]).tolist()


def portions(column, most: int = 1 << 22):
    """Slices of an Arrow column of texts of up to about ``most`` bytes; a longer text is a slice of its own."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.asarray(pc.binary_length(column))
    at = size = 0
    for k, n in enumerate(sizes.tolist()):
        if k > at and size + n > most:
            yield column.slice(at, k - at)
            at, size = k, 0
        size += n
    if len(column) > at:
        yield column.slice(at)
