"""Pixel kernels on one image each, in numpy. Images are (h, w) or (h, w, 3) arrays of uint8."""

from __future__ import annotations

import numpy as np


def gray(image: np.ndarray) -> np.ndarray:
    """Gray values of a BGR image, by whole-number weights of 14 bits."""
    if image.ndim == 2:
        return image
    b, g, r = (image[..., i].astype(np.int64) for i in range(3))
    return (b * 1868 + g * 9617 + r * 4899 + 8192 >> 14).astype(np.uint8)


def min_max(image: np.ndarray) -> np.ndarray:
    """Values spread over 0..255, rounded half to even in single precision; an image of one value becomes 0."""
    low, high = int(image.min(initial=255)), int(image.max(initial=0))
    if high <= low:
        return np.zeros_like(image)
    factor = 255.0 / (high - low)
    return np.rint(image.astype(np.float32) * np.float32(factor) + np.float32(-low * factor)).clip(0, 255).astype(np.uint8)


def otsu(image: np.ndarray) -> int:
    """Threshold that splits the histogram best; the least of equals."""
    n = np.bincount(image.ravel(), minlength=256).astype(float)
    v = np.arange(256)
    n0, s0 = np.cumsum(n), np.cumsum(n * v)
    n1 = n0[-1] - n0
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = np.where((n0 > 0) & (n1 > 0), (s0 * n0[-1] - s0[-1] * n0) ** 2 / (n0 * n1), 0.0)
    apart[n == 0] = -1
    return int(np.argmax(apart))


def gaussian_weights(size: int) -> np.ndarray:
    """Weights of a Gaussian window of odd size; small windows have the usual binomial ones."""
    if size % 2 == 0 or size < 1:
        raise ValueError("the window must be odd")
    if size in (1, 3, 5, 7):
        return np.array({1: [1], 3: [1, 2, 1], 5: [1, 4, 6, 4, 1], 7: [2, 7, 14, 18, 14, 7, 2]}[size]) / {1: 1, 3: 4, 5: 16, 7: 64}[size]
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    w = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
    return w / w.sum()


def _smooth(image: np.ndarray, size: int, mode: str) -> np.ndarray:
    w, r = gaussian_weights(size), size // 2
    out = np.pad(image.astype(float), r, mode=mode if min(image.shape) > r else "edge")
    out = sum(w[i] * out[i : i + image.shape[0]] for i in range(size))
    return sum(w[i] * out[:, i : i + image.shape[1]] for i in range(size))


def blur(image: np.ndarray, size: int) -> np.ndarray:
    """Gaussian blur; borders mirror."""
    return np.floor(_smooth(image, size, "reflect") + 0.5).astype(np.uint8)


def adaptive_threshold(image: np.ndarray, size: int, c: int, invert: bool = False) -> np.ndarray:
    """255 where a pixel is above its Gaussian mean less c; borders repeat."""
    above = image > np.floor(_smooth(image, size, "edge") + 0.5) - c
    return np.where(above != invert, 255, 0).astype(np.uint8)


def dilate(mask: np.ndarray, radius: int, ellipse: bool = False) -> np.ndarray:
    """Set wherever the window around a pixel holds a set one: a square, or rows of an ellipse."""
    h, w = mask.shape

    def along(rows: np.ndarray, reach: int) -> np.ndarray:
        """Set wherever a set one is within reach in the same row, by running counts."""
        upto = np.pad(np.cumsum(rows, axis=1, dtype=np.int32), ((0, 0), (1, 0)))
        x = np.arange(rows.shape[1])
        return upto[:, np.minimum(x + reach + 1, rows.shape[1])] > upto[:, np.maximum(x - reach, 0)]

    plain = mask.astype(bool)
    if not ellipse:
        return along(along(plain, radius).T, radius).T
    out = np.zeros((h, w), dtype=bool)
    for dy in range(-radius, radius + 1):
        wide = along(plain, int(round(np.sqrt(radius**2 - dy**2))))
        out[max(0, -dy) : h - max(0, dy)] |= wide[max(0, dy) : h - max(0, -dy)] if abs(dy) < h else False
    return out


def components(mask: np.ndarray) -> np.ndarray:
    """Labels 1.. of 8-connected parts, in the order of their first pixel; 0 where unset."""
    h, w = mask.shape
    parent = [0]
    runs: list[list[tuple[int, int, int]]] = []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for y in range(h):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask[y].astype(np.int8), [0]])))
        row = []
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            touching = [find(k) for s, e, k in (runs[-1] if runs else []) if s <= b and a <= e]
            k = min(touching, default=len(parent))
            if not touching:
                parent.append(k)
            for t in touching:
                parent[t] = k
            row.append((a, b, k))
        runs.append(row)
    out = np.zeros((h, w), dtype=np.int32)
    names: dict[int, int] = {}
    for y, row in enumerate(runs):
        for a, b, k in row:
            out[y, a:b] = names.setdefault(find(k), len(names) + 1)
    return out


def largest(labels: np.ndarray) -> int:
    """Label of most pixels, the lowest of equals; 0 if there is none."""
    n = np.bincount(labels.ravel())
    n[0] = 0
    return int(np.argmax(n)) if n.any() else 0


def contours(mask: np.ndarray) -> list[np.ndarray]:
    """Outer borders (x, y) of the 8-connected parts, corners only, in the order of their first pixel.

    A border is followed along its pixels, looking around each from the last direction on.
    """
    around = [(0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1)]
    labels = np.pad(components(mask), 1)
    out = []
    names, firsts = np.unique(labels, return_index=True)
    for k, first_place in zip(names.tolist(), firsts.tolist()):
        if not k:
            continue
        start = here = divmod(first_place, labels.shape[1])
        path, direction, first = [], 6, None
        while True:
            for turn in range(8):
                d = (direction + 6 + turn) % 8
                there = (here[0] + around[d][0], here[1] + around[d][1])
                if labels[there] == k:
                    break
            else:
                path.append((here, None))
                break
            if here == start and d == first:
                break
            first = d if first is None else first
            path.append((here, d))
            here, direction = there, d
        turns = [p for i, (p, d) in enumerate(path) if d is None or path[i - 1][1] != d]
        out.append(np.array([(x - 1, y - 1) for y, x in turns], dtype=np.int32))
    return out


def contour_area(points: np.ndarray) -> float:
    x, y = points[:, 0].astype(float), points[:, 1].astype(float)
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2


def contour_length(points: np.ndarray) -> float:
    return float(np.hypot(*(np.roll(points, -1, axis=0) - points).T.astype(float)).sum())


def simplified(points: np.ndarray, tolerance: float) -> np.ndarray:
    """A closed ring with fewer vertices, none of the others farther than the tolerance (Douglas and Peucker)."""
    n = len(points)
    if n < 4:
        return points
    p = points.astype(float)
    far = int(np.argmax(((p - p[0]) ** 2).sum(axis=1)))
    keep = {0, far}
    ring = np.concatenate([p, p[:1]])
    stack = [(0, far), (far, n)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        d, base = ring[a + 1 : b] - ring[a], ring[b] - ring[a]
        size = np.hypot(*base)
        gap = np.abs(d[:, 0] * base[1] - d[:, 1] * base[0]) / size if size else np.hypot(*d.T)
        i = int(np.argmax(gap))
        if gap[i] > tolerance:
            keep.add((a + 1 + i) % n)
            stack += [(a, a + 1 + i), (a + 1 + i, b)]
    return points[sorted(keep)]


def mask_polygons(mask: np.ndarray, min_area: float = 25.0, ratio: float = 0.002) -> list[np.ndarray]:
    """Simplified outer borders of a mask: of ``min_area`` and three vertices at least."""
    found = [c for c in contours(mask) if len(c) and contour_area(c) >= min_area]
    return [s for c in found if len(s := simplified(c, ratio * contour_length(c))) >= 3]


def dark_mask(image: np.ndarray) -> np.ndarray:
    """Dark lines on a light ground: what isn't above the Otsu threshold."""
    return gray(image) <= otsu(gray(image))


def filled(shape: tuple[int, int], polygons: list[np.ndarray]) -> np.ndarray:
    """Pixels in or on whole-pixel polygons, by the even-odd rule on scan lines."""
    out = outlined(shape, polygons)
    h, w = shape
    for p in polygons:
        x, y = p[:, 0].astype(float), p[:, 1].astype(float)
        x2, y2 = np.roll(x, -1), np.roll(y, -1)
        for row in range(max(0, int(y.min())), min(h, int(y.max()) + 1)):
            hit = ((y <= row) & (row < y2)) | ((y2 <= row) & (row < y))
            at = np.sort(x[hit] + (row - y[hit]) * (x2[hit] - x[hit]) / (y2[hit] - y[hit]))
            for a, b in zip(at[::2], at[1::2]):
                out[row, max(0, int(np.ceil(a))) : max(0, min(w, int(np.floor(b)) + 1))] = True
    return out


def outlined(shape: tuple[int, int], polygons: list[np.ndarray], thickness: int = 1) -> np.ndarray:
    """Pixels on the edges of polygons."""
    out = np.zeros(shape, dtype=bool)
    for p in polygons:
        for (xa, ya), (xb, yb) in zip(p.tolist(), np.roll(p, -1, axis=0).tolist()):
            n = max(abs(xb - xa), abs(yb - ya), 1)
            t = np.arange(n + 1) / n
            xs, ys = np.round(xa + t * (xb - xa)).astype(int), np.round(ya + t * (yb - ya)).astype(int)
            able = (xs >= 0) & (xs < shape[1]) & (ys >= 0) & (ys < shape[0])
            out[ys[able], xs[able]] = True
    return dilate(out, thickness // 2) if thickness > 1 else out


def label_styled(image: np.ndarray, polygons: list[np.ndarray], edge: int = 1, ring: int = 3, block: int = 31, c: int = 5) -> np.ndarray:
    """A label's look: binarised, white inside, black edges, then a white ring around."""
    out = adaptive_threshold(blur(gray(image), 3), block, c)
    if not polygons:
        return out
    inside = filled(out.shape, polygons)
    out[inside] = 255
    out[outlined(out.shape, polygons, edge)] = 0
    if ring > 0:
        out[dilate(inside, ring, ellipse=True) & ~inside] = 255
    return out


def preprocessed(image: np.ndarray, mode: str = "bin", size: int = 3, block: int = 31, c: int = 5) -> np.ndarray:
    """Gray, spread (norm) or binarised (bin) image; the blur is for ``bin`` alone."""
    if mode not in ("gray", "norm", "bin"):
        raise ValueError(f"unknown mode {mode}")
    g = gray(image)
    if mode == "gray":
        return g
    g = min_max(g)
    return g if mode == "norm" else adaptive_threshold(blur(g, size) if size > 1 else g, block, c)


def tile(image: np.ndarray, ty: int, tx: int, side: int) -> np.ndarray:
    """A tile, white where it goes beyond the page."""
    part = image[ty : ty + side, tx : tx + side]
    out = np.full((side, side, *image.shape[2:]), 255, dtype=np.uint8)
    out[: part.shape[0], : part.shape[1]] = part
    return out


def turned(image: np.ndarray, angle: int) -> np.ndarray:
    """The image turned clockwise by 90, 180 or 270 degrees."""
    return np.rot90(image, -angle // 90 % 4).copy()


def resized(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Area means of the source cells under each pixel."""

    def weights(n: int, m: int) -> np.ndarray:
        edges = np.arange(m + 1) * n / m
        cells = np.arange(n)
        part = np.minimum(edges[1:, None], cells + 1) - np.maximum(edges[:-1, None], cells)
        part = np.clip(part, 0, None)
        return part / part.sum(axis=1, keepdims=True)

    flat = image.reshape(image.shape[0], image.shape[1], -1).astype(float)
    out = np.einsum("ij,jkc->ikc", weights(image.shape[0], h), flat)
    out = np.einsum("ij,kjc->kic", weights(image.shape[1], w), out)
    return np.floor(out + 0.5).astype(np.uint8).reshape(h, w, *image.shape[2:])


def blended(a: np.ndarray, b: np.ndarray, of_a: float, of_b: float) -> np.ndarray:
    return np.clip(np.round(a * of_a + b * of_b), 0, 255).astype(np.uint8)


def auto_crop(image: np.ndarray, pad: int = 20, below: int = 230) -> tuple[int, int, int, int]:
    """y1, y2, x1, x2 (half-open) of the ink, widened by ``pad``."""
    ink = gray(image) <= below
    h, w = ink.shape
    rows, cols = np.flatnonzero(ink.sum(axis=1) > 0.01 * w), np.flatnonzero(ink.sum(axis=0) > 0.01 * h)
    if not len(rows) or not len(cols):
        return 0, h, 0, w
    return max(0, int(rows[0]) - pad), min(h, int(rows[-1]) + pad), max(0, int(cols[0]) - pad), min(w, int(cols[-1]) + pad)


def border_ring(mask: np.ndarray, share: float = 0.05) -> np.ndarray:
    """The ring along the inside of the mask's box, of whole pixels; none if ``share`` of the shorter side is less than one."""
    out = np.zeros(mask.shape, dtype=bool)
    ys, xs = np.nonzero(mask)
    if not len(ys):
        return out
    y1, y2, x1, x2 = int(ys.min()), int(ys.max()), int(xs.min()), int(xs.max())
    if wide := int(min(y2 - y1, x2 - x1) * share):
        out[y1:y2, x1:x2] = True
        out[y1 + wide : max(y1 + wide, y2 - wide), x1 + wide : max(x1 + wide, x2 - wide)] = False
    return out


def outer_inner(image: np.ndarray, mask: np.ndarray, white: int = 220, reach: int = 20, share: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Outer pixels of a mask (near the largest white part, or in the border ring) and the others."""
    light = components(gray(image) > white)
    k = largest(light)
    near = dilate(light == k, reach) if k else np.zeros(mask.shape, dtype=bool)
    outer = mask & (near | border_ring(mask, share))
    return outer, mask & ~outer


def traced(mask: np.ndarray, min_area: float = 200.0, ratio: float = 0.01) -> np.ndarray:
    """Simplified outlines of a mask's parts of ``min_area`` at least, as lines; shapes of two vertices are lines, too."""
    rings = [c for c in contours(mask) if len(c) and contour_area(c) >= min_area]
    return outlined(mask.shape, [simplified(c, ratio * contour_length(c)) for c in rings], 2)


def three_channels(image: np.ndarray) -> np.ndarray:
    """A gray image as BGR."""
    return image if image.ndim == 3 else np.repeat(image[..., None], 3, axis=2)


def painted(image: np.ndarray, where: np.ndarray, color: tuple[int, int, int]) -> np.ndarray:
    """A BGR copy of an image with some pixels in a color."""
    out = three_channels(image).copy()
    out[where] = color
    return out


#: Colors of drawings, as BGR (fixed values).
RED, GREEN, CYAN = (0, 0, 255), (0, 200, 0), (255, 255, 0)


def overlaid(image: np.ndarray, mask: np.ndarray, min_area: float = 200.0, ratio: float = 0.01) -> np.ndarray:
    """A page with the traced outlines of a mask in red."""
    return painted(image, traced(mask, min_area, ratio), RED)


def overlaid_plain(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """A page with a mask's untraced outlines in red and its parts tinted green."""
    lines = painted(image, outlined(mask.shape, contours(mask), 3), RED)
    tint = painted(np.zeros(mask.shape, dtype=np.uint8), mask.astype(bool), GREEN)
    return blended(lines, tint, 1.0, 0.4)


def labelled(image: np.ndarray, polygons: list[np.ndarray]) -> np.ndarray:
    """A page with label polygons tinted green and outlined in red."""
    page, inside = three_channels(image), np.zeros(image.shape[:2], dtype=bool)
    for p in polygons:
        inside |= filled(inside.shape, [p])
    return painted(blended(page, painted(page, inside, GREEN), 0.55, 0.45), outlined(inside.shape, polygons, 2), RED)


def classified(image: np.ndarray, mask: np.ndarray, outer: np.ndarray, inner: np.ndarray, min_area: float = 200.0) -> np.ndarray:
    """A page with the outlines of a mask's parts: green where outer, red where inner, and its box in cyan."""
    lines = outlined(mask.shape, [c for c in contours(mask) if len(c) and contour_area(c) >= min_area], 2)
    out = painted(painted(image, lines & outer, GREEN), lines & inner, RED)
    ys, xs = np.nonzero(mask)
    if len(ys):
        box = np.array([[xs.min(), ys.min()], [xs.max(), ys.min()], [xs.max(), ys.max()], [xs.min(), ys.max()]])
        out = painted(out, outlined(mask.shape, [box], 2), CYAN)
    return out


def sampled_linear(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """A float image at another size, linear between pixel centers; borders repeat."""

    def places(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, n - 1), at - low

    y0, y1, fy = places(image.shape[0], h)
    x0, x1, fx = places(image.shape[1], w)
    rows = image[y0] * (1 - fy)[:, None] + image[y1] * fy[:, None]
    return rows[:, x0] * (1 - fx) + rows[:, x1] * fx


def resized_cubic(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """An image at another size by cubic convolution (a = -0.5), widened when it shrinks; weights beyond the border go."""

    def weights(n: int, m: int) -> np.ndarray:
        scale = max(1.0, n / m)
        d = np.abs((np.arange(n) + 0.5)[None, :] - ((np.arange(m) + 0.5) * n / m)[:, None]) / scale
        near = (1.5 * d - 2.5) * d * d + 1
        far = ((-0.5 * d + 2.5) * d - 4) * d + 2
        k = np.where(d < 1, near, np.where(d < 2, far, 0.0))
        return k / k.sum(axis=1, keepdims=True)

    flat = image.reshape(image.shape[0], image.shape[1], -1).astype(float)
    out = np.einsum("ij,jkc->ikc", weights(image.shape[0], h), flat)
    out = np.einsum("ij,kjc->kic", weights(image.shape[1], w), np.floor(out.clip(0, 255) + 0.5))
    return np.floor(out.clip(0, 255) + 0.5).astype(np.uint8).reshape(h, w, *image.shape[2:])
