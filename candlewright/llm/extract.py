"""Main text of web pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi."""

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.llm.blocks import Block, blocks

#: Labelled pages a model is fitted on at most: the first by a hash of the page.
PAGES = 2000
ROUNDS = 120
PENALTY = 0.05
#: Blocks in which a trait has to occur to get a weight.
SEEN = 2
# Words that tell what a short block is.
TELLING = frozenset(
    "cookie cookies copyright subscribe newsletter share login advertisement sponsored comment comments reply menu privacy terms search".split()
)
LETTERS = re.compile(r"[^\W\d_]+")


def text_traits(block: Block) -> list[str]:
    text = block.text
    size = len(text)
    linked = block.linked / size
    words = text.count(" ") + 1
    out = [
        f"size {min(size.bit_length(), 10)}",
        f"words {min(words.bit_length(), 8)}",
        f"linked {0 if not linked else 1 if linked < 0.4 else 2 if linked < 0.8 else 3}",
        f"ends {'stop' if text[-1] in '.!?…。！？' else 'colon' if text[-1] in ':;,' else 'open'}",
    ]
    if "©" in text or "·" in text or "|" in text:
        out.append("mark")
    if size < 200:
        out += {f"says {w}" for w in (m.group().lower() for m in LETTERS.finditer(text)) if w in TELLING}
    return out


def traits(block: Block) -> list[str]:
    return ["any", *block.traits, *text_traits(block)]


@dataclass
class Model:
    """``weight``: what each trait adds for a block of the main text. ``step[k][a][b]``: for b after a, in another (0) or the same container (1)."""

    weight: dict[str, float]
    step: list[list[list[float]]]
    first: list[float]
    last: list[float]

    def labels(self, page: list[Block]) -> list[int]:
        """The most probable labels of a page's blocks (Viterbi); of equal ones the one with more text kept."""
        if not page:
            return []
        get = self.weight.get
        back, before = [], None
        off = on = 0.0
        for block in page:
            own = sum(get(t, 0.0) for t in traits(block))
            if before is None:
                off, on = self.first[0], self.first[1] + own
            else:
                step = self.step[block.container == before]
                from_off = (off + step[0][0], off + step[0][1])
                from_on = (on + step[1][0], on + step[1][1])
                back.append((int(from_on[0] >= from_off[0]), int(from_on[1] >= from_off[1])))
                off, on = max(from_off[0], from_on[0]), max(from_off[1], from_on[1]) + own
            before = block.container
        label = int(on + self.last[1] >= off + self.last[0])
        out = [label]
        for choice in reversed(back):
            label = choice[label]
            out.append(label)
        return out[::-1]

    def text(self, page: str) -> str:
        found = blocks(page)
        return "\n\n".join(b.text for b, kept in zip(found, self.labels(found), strict=True) if kept)


def labelled(page: str, main: list[str]) -> list[tuple[list[str], int, int]]:
    """(traits, container, label) of each block; the texts of ``main`` are found in page order."""
    out, at = [], 0
    for block in blocks(page):
        kept = at < len(main) and block.text == main[at]
        at += kept
        out.append((traits(block), block.container, int(kept)))
    return out


def log_likelihood(emission, same, label, inside, step, first, last):
    """Log-likelihood of padded pages, and what to add to each parameter to raise it.

    ``emission`` (pages, blocks) is the score of label 1 over label 0; ``inside`` marks real blocks.
    Forward and backward sums run over all pages at once, a block at a time.
    """
    pages, length = emission.shape
    score = np.zeros((pages, length, 2))
    score[:, :, 1] = emission
    steps = step[same.astype(int)]  # (pages, blocks, 2, 2), into each block
    forward = np.zeros((pages, length, 2))
    forward[:, 0] = first + score[:, 0]
    for t in range(1, length):
        new = np.logaddexp.reduce(forward[:, t - 1, :, None] + steps[:, t], axis=1) + score[:, t]
        forward[:, t] = np.where(inside[:, t, None], new, forward[:, t - 1])
    total = np.logaddexp.reduce(forward[:, -1] + last, axis=1)
    backward = np.zeros((pages, length, 2))
    backward[:, -1] = last
    for t in range(length - 2, -1, -1):
        new = np.logaddexp.reduce(steps[:, t + 1] + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
        backward[:, t] = np.where(inside[:, t + 1, None], new, backward[:, t + 1])
    chance = np.exp(forward + backward - total[:, None, None]) * inside[:, :, None]
    rows = np.arange(pages)
    size = inside.sum(axis=1)
    end = label[rows, size - 1]
    value = first[label[:, 0]].sum() + last[end].sum() + (emission * label * inside).sum()
    d_step = np.zeros_like(step)
    for t in range(1, length):
        on = inside[:, t]
        if not on.any():
            break
        pair = np.exp(
            forward[on, t - 1, :, None] + steps[on, t] + (score[on, t] + backward[on, t])[:, None, :] - total[on, None, None]
        )
        kinds = same[on, t].astype(int)
        np.add.at(d_step, kinds, -pair)
        np.add.at(d_step, (kinds, label[on, t - 1], label[on, t]), 1.0)
        value += step[kinds, label[on, t - 1], label[on, t]].sum()
    d_first = np.bincount(label[:, 0], minlength=2) - chance[:, 0].sum(axis=0)
    d_last = np.bincount(end, minlength=2) - chance[rows, size - 1].sum(axis=0)
    return value - total.sum(), (label - chance[:, :, 1]) * inside, d_step, d_first, d_last


def trained(pages: list[list[tuple[list[str], int, int]]], rounds: int = ROUNDS, penalty: float = PENALTY) -> Model:
    """Parameters that maximise the penalised likelihood, by steps of adaptive size."""
    pages = [p for p in pages if p]
    seen = Counter(t for page in pages for found, _, _ in page for t in set(found))
    names = sorted(t for t, n in seen.items() if n >= SEEN)
    number = {t: k for k, t in enumerate(names)}
    length = max((len(p) for p in pages), default=1)
    shape = (len(pages), length)
    label, same, inside = np.zeros(shape, int), np.zeros(shape, bool), np.zeros(shape, bool)
    trait, place = [], []
    for i, page in enumerate(pages):
        for t, (found, container, kept) in enumerate(page):
            label[i, t], inside[i, t], same[i, t] = kept, True, bool(t) and page[t - 1][1] == container
            known = {number[x] for x in found if x in number}
            trait += known
            place += [i * length + t] * len(known)
    trait, place = np.array(trait, int), np.array(place, int)
    sizes = [len(names), 8, 2, 2]
    cut = np.cumsum(sizes)
    x, mean, square = np.zeros(cut[-1]), np.zeros(cut[-1]), np.zeros(cut[-1])
    for k in range(1, rounds + 1 if pages else 1):
        weight, step, first, last = np.split(x, cut[:-1])
        emission = np.bincount(place, weights=weight[trait], minlength=shape[0] * length).reshape(shape)
        _, d_emission, *rest = log_likelihood(emission, same, label, inside, step.reshape(2, 2, 2), first, last)
        slope = np.concatenate([np.bincount(trait, weights=d_emission.ravel()[place], minlength=len(names)), *[r.ravel() for r in rest]])
        slope -= penalty * x
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        x = x + 0.2 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    weight, step, first, last = np.split(x, cut[:-1])
    return Model(dict(zip(names, weight.tolist(), strict=True)), step.reshape(2, 2, 2).tolist(), first.tolist(), last.tolist())


def fit(pages: DataFrame, html_col="html", main_col="main", max_pages: int = PAGES) -> Model:
    """A model from labelled pages: html, and the texts of the blocks of its main text in page order.

    At most ``max_pages`` different pages, the first by a hash, bring their blocks to the driver. Rows without
    html are left out, a null ``main`` means none of the page. Without labelled pages every weight is 0.
    """
    rows = pages.select(F.col(html_col).alias("html"), F.coalesce(F.col(main_col), F.array().cast("array<string>")).alias("main")).where("html IS NOT NULL").distinct()
    chosen = rows.orderBy(F.xxhash64("html"), "html", "main").limit(max_pages)

    def cut(batches):
        for batch in batches:
            for page, main in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = labelled(page, main)
                yield pa.record_batch(
                    [pa.array([page], pa.string()), pa.array([[f[0] for f in found]], pa.list_(pa.list_(pa.string()))),
                     pa.array([[f[1] for f in found]], pa.list_(pa.int64())), pa.array([[f[2] for f in found]], pa.list_(pa.int64()))],
                    names=["html", "traits", "container", "label"],
                )

    made = chosen.mapInArrow(cut, "html string, traits array<array<string>>, container array<long>, label array<long>")
    found = made.orderBy("html", "label").drop("html").collect()
    return trained([list(zip(r.traits, r.container, r.label, strict=True)) for r in found])


def main_text(pages: DataFrame, model: Model, carried: Column, html_col="html") -> DataFrame:
    """``carried`` (a struct, as column row) with text: the blocks of the main text, two line feeds between.

    The whole html is read; null and empty html give an empty text. Rows are independent of each other, so
    nothing is shuffled and repeated rows come out alike; other columns are not read. A page needs
    memory for its blocks.
    """
    kept = pages.select(carried.alias("row"), F.col(html_col).cast("string").alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast((model.weight, model.step, model.first, model.last))

    def rows(batches):
        own = Model(*shared.value)
        for batch in batches:
            texts = [own.text(page.as_py() or "") for page in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    return kept.mapInArrow(rows, f"row {kept.schema['row'].dataType.simpleString()}, text string")
