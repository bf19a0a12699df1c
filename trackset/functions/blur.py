"""Sharpness of an image region: the variance of its Laplacian."""

from __future__ import annotations

import numpy as np


def laplacian(image: np.ndarray) -> np.ndarray:
    """The sum of the four neighbours less four times the pixel; beyond the border the image is mirrored about it."""
    wide = np.pad(image.astype("f8"), [(1, 1) if n > 1 else (0, 0) for n in image.shape], mode="reflect")
    wide = np.pad(wide, [(0, 0) if n > 1 else (1, 1) for n in image.shape], mode="edge")
    return wide[:-2, 1:-1] + wide[2:, 1:-1] + wide[1:-1, :-2] + wide[1:-1, 2:] - 4 * wide[1:-1, 1:-1]


def sharpness(image: np.ndarray, xmin: int, ymin: int, xmax: int, ymax: int, least: int = 4) -> float:
    """Population variance over the part of an inclusive box that lies in the image; 0 below `least` pixels."""
    crop = image[max(0, ymin) : max(0, ymax + 1), max(0, xmin) : max(0, xmax + 1)]
    return float(laplacian(crop).var()) if crop.size >= least else 0.0
