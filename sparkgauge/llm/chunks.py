"""Work done once per chunk of text: slices of rows, and a memory of chunks seen before."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator

SLICE_CHARS = 1 << 20
# Characters a generation of remembered chunks may have, each chunk counted with its overhead.
REMEMBERED, OVERHEAD = 100_000_000, 200


class Chunks:
    """Values of chunks, worked out in batches; frequent chunks outlive rare ones.

    When a generation is full it becomes the old one, and the one before it is forgotten;
    what is asked for again moves to the young one. Memory is bounded by two generations
    and one slice.
    """

    def __init__(self, work: Callable[[list], Iterable], remembered: int = REMEMBERED):
        self.work, self.remembered = work, remembered
        self.young: dict[Hashable, object] = {}
        self.old: dict[Hashable, object] = {}
        self.size = 0

    def values(self, chunks: Iterable[Hashable]) -> dict:
        """A mapping that has at least these chunks; valid until the next call."""
        if self.size > self.remembered:
            self.old, self.young, self.size = self.young, {}, 0
        new, old, fresh = set(chunks) - self.young.keys(), self.old, []
        for c in new:
            if c in old:
                self.young[c] = old[c]
            else:
                fresh.append(c)
        self.young.update(zip(fresh, self.work(fresh)))
        self.size += sum(map(len, new)) + OVERHEAD * len(new)
        return self.young

    def each(self, chunks: list) -> list:
        """The values of chunks none of which is there twice, in their order; one look-up per known chunk."""
        if self.size > self.remembered:
            self.old, self.young, self.size = self.young, {}, 0
        out = list(map(self.young.get, chunks))
        at = [i for i, v in enumerate(out) if v is None]
        new = [chunks[i] for i in at]
        again = list(map(self.old.get, new))
        fresh = [c for c, v in zip(new, again) if v is None]
        made = iter(self.work(fresh))
        for i, c, v in zip(at, new, again):
            out[i] = self.young[c] = next(made) if v is None else v
        self.size += sum(map(len, new)) + OVERHEAD * len(new)
        return out


def slices(rows: Iterable[tuple], text_at: int, chars: int = SLICE_CHARS) -> Iterator[list[tuple]]:
    """Rows in runs of about so many characters of text, so that a task holds the tokens of one run."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text_at] or "")
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held
