"""Encoder and segmenter plug-in points.

A plug-in is a small class; Spark partitions the patches or tiles, Arrow
carries the batches, and the model is built once per Python worker.
"""

from __future__ import annotations

import warnings
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoframe.operators import patches as G


class Encoder(ABC):
    """Patch encoder.

    ``required_markers`` are names an encoder cannot do without; they only
    warn. ``load`` builds the model inside a worker. ``transform`` prepares
    a batch, ``forward`` turns it into one vector per patch.
    """

    name: str = ""
    version: str = "1"
    required_markers: tuple[str, ...] = ()

    def load(self) -> object:
        return None

    def embed_markers(self, markers: list[str]) -> list[str]:
        """Names as the model knows them, computed once per panel."""
        return markers

    def transform(self, batch, markers: list[str]):  # noqa: ANN001, ANN201
        return batch

    @abstractmethod
    def forward(self, model: object, batch, markers: list[str]):  # noqa: ANN001, ANN201
        """(n, channel, row, column) array to (n, d) array."""

    def provenance(self, markers: list[str]) -> dict[str, str]:
        return {"encoder": self.name, "version": self.version, "markers": ",".join(markers)}


class Segmenter(ABC):
    """Tile segmenter: (row, column, channel) planes to a probability per pixel."""

    name: str = ""

    @abstractmethod
    def segment(self, planes):  # noqa: ANN001, ANN201
        """(channel, row, column) array to (row, column) array in [0, 1]."""


def make_registry(base: type) -> tuple[Callable[[str], Callable[[type], type]], Callable[[str], type], Callable[[], list[str]]]:
    """(register, get, names) over subclasses of ``base``.

    Registering another class is a TypeError; a taken name is replaced with
    a warning; an unknown name lists the known ones.
    """
    known: dict[str, type] = {}

    def register(name: str) -> Callable[[type], type]:
        def add(cls: type) -> type:
            if not (isinstance(cls, type) and issubclass(cls, base)):
                raise TypeError(f"{cls!r} is not a {base.__name__}")
            if name in known:
                warnings.warn(f"{name!r} replaced in the {base.__name__} registry", stacklevel=2)
            known[name] = cls
            cls.name = name
            return cls

        return add

    def get(name: str) -> type:
        if name not in known:
            raise KeyError(f"unknown {base.__name__.lower()} {name!r}; known: {sorted(known)}")
        return known[name]

    return register, get, lambda: sorted(known)


register_encoder, get_encoder, encoder_names = make_registry(Encoder)
register_segmenter, get_segmenter, segmenter_names = make_registry(Segmenter)


def patch_tensors(pixels: DataFrame, slides: DataFrame, size: int, stride: int, background: DataFrame | None = None) -> DataFrame:
    """Sparse pixels of every patch in one row, as four arrays of at most size * size * channels entries.

    A patch without a pixel has empty arrays. ``background`` (slide_id, c,
    value) says what absent pixels read, if not 0.
    """
    inside = G.box_pixels(pixels, slides, size, stride)
    filled = inside.groupBy("slide_id", "patch_id").agg(F.collect_list(F.struct("c", "dy", "dx", "v")).alias("_px"))
    grid = G.grid_patches(slides, size, stride).select("slide_id", "patch_id").join(filled, ["slide_id", "patch_id"], "left")
    px = F.coalesce("_px", F.array().cast(filled.schema["_px"].dataType))
    listed = grid.withColumn("_px", px).select("slide_id", "patch_id", *[F.col(f"_px.{c}").alias(c) for c in ("c", "dy", "dx", "v")])
    if background is None:
        return listed
    bare = background.groupBy("slide_id").agg(F.map_from_entries(F.collect_list(F.struct("c", "value"))).alias("_bare"))
    return listed.join(bare, "slide_id", "left").withColumns({"bare_c": F.map_keys("_bare"), "bare_v": F.map_values("_bare")}).drop("_bare")


def encode(tensors: DataFrame, encoder: Encoder, channels: list[int], markers: list[str], size: int, batch_size: int = 64) -> DataFrame:
    """Feature vector of each patch, in batches of ``batch_size``."""
    names = encoder.embed_markers(markers)

    def run(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        model = encoder.load()
        slot = np.full(max(channels, default=0) + 1, -1)
        slot[channels] = np.arange(len(channels))
        for frame in frames:
            for s in range(0, len(frame), batch_size):
                part = frame.iloc[s : s + batch_size]
                batch = np.zeros((len(part), len(channels), size, size))
                if "bare_c" in part:
                    for i, (bare_c, bare_v) in enumerate(zip(part["bare_c"], part["bare_v"])):
                        level = dict(zip(bare_c, bare_v)) if bare_c is not None else {}
                        batch[i] += np.array([level.get(c, 0.0) for c in channels])[:, None, None]
                owner = np.repeat(np.arange(len(part)), [len(c) for c in part["c"]])
                c, dy, dx, v = (np.concatenate(part[name].to_list()) for name in ("c", "dy", "dx", "v"))
                known = c < len(slot)
                known[known] = slot[c[known].astype(int)] >= 0
                at = (owner[known], slot[c[known].astype(int)], dy[known].astype(int), dx[known].astype(int))
                batch[at] = v[known]
                vectors = np.asarray(encoder.forward(model, encoder.transform(batch, names), names), dtype="float64")
                yield pd.DataFrame(
                    {"slide_id": part["slide_id"].to_numpy(), "patch_id": part["patch_id"].to_numpy(), "features": list(vectors)}
                )

    return tensors.mapInPandas(run, "slide_id int, patch_id int, features array<double>")


def segment(pixels: DataFrame, slides: DataFrame, segmenter: Segmenter, channels: list[int], size: int, stride: int) -> DataFrame:
    """Tile predictions (slide_id, y, x, p) of a segmenter, to be voted over.

    One group is one tile, size * size * channels pixels at most; a tile
    without any pixel predicts nothing and reads as background. Predictions
    come dealt by image row, so that a vote is summed after the shuffle and
    not beside the segmenter; equal ones take few bytes and as much memory as
    others, so there are more partitions than usual, and a fixed number.
    """
    tiles = G.with_patches(pixels.filter(F.col("c").isin(*channels)), slides, size, stride)

    def run(key, tile):  # noqa: ANN001, ANN202
        import numpy as np
        import pandas as pd

        slot = {c: i for i, c in enumerate(channels)}
        y0, x0 = int(tile["_py"].iloc[0]), int(tile["_px"].iloc[0])
        planes = np.zeros((len(channels), size, size))
        planes[tile["c"].map(slot).to_numpy(), tile["y"].to_numpy() - y0, tile["x"].to_numpy() - x0] = tile["v"].to_numpy()
        prob = np.asarray(segmenter.segment(planes), dtype="float64")
        ys, xs = np.indices(prob.shape)
        return pd.DataFrame({"slide_id": int(key[0]), "y": (ys + y0).ravel(), "x": (xs + x0).ravel(), "p": prob.ravel()})

    starts = G.grid_patches(slides, size, stride).select("slide_id", "patch_id", F.col("y").alias("_py"), F.col("x").alias("_px"))
    found = tiles.join(starts, ["slide_id", "patch_id"]).groupBy("slide_id", "patch_id").applyInPandas(run, "slide_id int, y int, x int, p double")
    return found.repartition(4 * int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions")), "slide_id", "y")
