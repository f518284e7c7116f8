"""Unigram token counts by dynamic programming over a trie of distinct pre-tokens (operator 9)."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.arrow import column_bytes
from corpusloom.llm.common import load

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MOST_PIECES = 1_000_000
MOST_NODES = 1_200_000
LONGEST = 4096
PIECE = 1 << 20
SPACE = "▁"
_BLANK = re.compile(rb"[\t-\r ]")


def pieces(path: str = MODEL) -> dict[str, float]:
    """The pieces of a public vocabulary with unigram scores. The file orders them by rank and has no probabilities, so a
    piece at place i scores -log(i + 2), Zipf's law. Control, unknown and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    if n > MOST_PIECES:
        raise ValueError(f"{n} pieces; {MOST_PIECES} are sent to the executors at most")
    return {model.id_to_piece(i): -math.log(i + 2) for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}


class Trie(dict):
    """Distinct pre-tokens share their prefixes: each node holds the best score of any segmentation of its prefix and the
    tokens of that segmentation (the fewest among equals), computed once from the nodes above it.

    As a dictionary it holds the terminal counts by the pre-token's bytes; a pre-token that isn't there is inserted and counted.
    Children are found by node and character in one table. Pieces that end at a node are tried from the shortest, as long as
    some piece ends like that.
    """

    def __init__(self, scores: dict[str, float], most_nodes: int = MOST_NODES):
        super().__init__()
        self.scores = scores
        self.endings = {p[i:] for p in scores for i in range(len(p))}
        self.unknown = min(scores.values(), default=0.0) - 10.0
        self.most_nodes = most_nodes
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.child: dict[int, int] = {}
        self.best: list[float] = [0.0]
        self.tokens: list[int] = [0]

    def __missing__(self, word: bytes) -> int:
        """Tokens of a new pre-token; a character that no piece covers is spelt in UTF-8 bytes, a token each."""
        if len(self.best) > self.most_nodes or len(self) > self.most_nodes:
            self.empty()
        if len(word) > LONGEST:
            return self.long(word)
        text = SPACE + word.decode("utf-8", "replace")
        child, best, tokens, scores, endings = self.child, self.best, self.tokens, self.scores, self.endings
        path = [0]
        at = 0
        for i, c in enumerate(text):
            key = at << 21 | ord(c)
            nxt = child.get(key)
            if nxt is None:
                low, few = best[at] + self.unknown, tokens[at] + len(c.encode("utf-8", "surrogatepass"))
                for j in range(i, -1, -1):
                    piece = text[j : i + 1]
                    score = scores.get(piece)
                    if score is not None:
                        score += best[path[j]]
                        if score > low or score == low and tokens[path[j]] + 1 < few:
                            low, few = score, tokens[path[j]] + 1
                    elif piece not in endings:
                        break
                nxt = child[key] = len(best)
                best.append(low)
                tokens.append(few)
            at = nxt
            path.append(at)
        self[word] = tokens[at]
        return tokens[at]


    def long(self, word: bytes) -> int:
        """Tokens of a very long pre-token, by the same recurrence over the last places alone: nothing of it is stored."""
        text = SPACE + word.decode("utf-8", "replace")
        scores, endings, reach = self.scores, self.endings, max(map(len, self.scores), default=1) + 1
        best, tokens = [0.0] * reach, [0] * reach  # of the place i, at i modulo reach
        for i, c in enumerate(text):
            low, few = best[i % reach] + self.unknown, tokens[i % reach] + len(c.encode("utf-8", "surrogatepass"))
            for j in range(i, max(-1, i - reach + 1), -1):
                piece = text[j : i + 1]
                score = scores.get(piece)
                if score is not None:
                    score += best[j % reach]
                    if score > low or score == low and tokens[j % reach] + 1 < few:
                        low, few = score, tokens[j % reach] + 1
                elif piece not in endings:
                    break
            best[(i + 1) % reach], tokens[(i + 1) % reach] = low, few
        return tokens[len(text) % reach]


def _spans(data: bytes) -> Iterator[bytes]:
    """A long text in pieces that end at white space."""
    at = 0
    while at < len(data):
        end = at + PIECE
        m = _BLANK.search(data, end)
        end = m.start() if m else len(data)
        yield data[at:end]
        at = end


#: The trie of this worker, kept from task to task, by the name of its vocabulary.
_OWN: dict[str, Trie] = {}


def _counting(shared, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _OWN.get(name)
        if trie is None:
            _OWN.clear()
            trie = _OWN[name] = Trie(shared.value)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            off, data = column_bytes(batch.column(at))
            view, words, tokens = memoryview(data), [], []
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                n = count = 0
                for part in _spans(bytes(view[a:b])) if b - a > 2 * PIECE else (bytes(view[a:b]),):
                    found = part.split()
                    n += len(found)
                    count += sum(map(trie.__getitem__, found))
                words.append(n)
                tokens.append(count)
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], [*(batch.schema.names[i] for i in rest), "n_pretokens", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` with n_pretokens (runs between white space) and n_tokens in place of text.

    One pass, no shuffle: each Python worker keeps a trie over the batches it sees and starts it anew beyond a bound of
    nodes, which changes no count; pre-tokens of more than 4,096 bytes are counted without it. Null and blank texts have no tokens;
    repeated rows a count each. An empty table gives an empty one. Columns n_pretokens and n_tokens of ``docs`` are replaced, others
    stay. Texts of more than 2 MB are split in pieces of about 1 MB. ``path`` is read by the driver alone.
    """
    docs = docs.drop("n_pretokens", "n_tokens")
    scores = pieces(path)
    name = hashlib.sha256(repr(sorted(scores.items())).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(scores)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    return docs.mapInArrow(_counting(shared, name), f"{kept}, n_pretokens long, n_tokens long")


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_pretokens and n_tokens of every document."""
    return token_counts(load(spark, sf_dir, "documents").select("doc_id", "text"))
