"""Kernels on hand-made images whose results follow by hand."""

import numpy as np
import pytest

from tilewright.operators import kernels as K


def box(shape, *rects):
    m = np.zeros(shape, dtype=bool)
    for y1, y2, x1, x2 in rects:
        m[y1:y2, x1:x2] = True
    return m


def test_contours_of_a_rectangle_and_an_l():
    (c,) = K.contours(box((10, 12), (2, 7, 3, 9)))
    assert sorted(map(tuple, c.tolist())) == [(3, 2), (3, 6), (8, 2), (8, 6)]
    assert K.contour_area(c) == 20 and K.contour_length(c) == 18
    (c,) = K.contours(box((10, 10), (1, 8, 1, 3), (6, 8, 1, 8)))
    assert len(K.simplified(c, 0.5)) >= 6
    assert K.contours(box((4, 4), (1, 2, 1, 2)))[0].tolist() == [[1, 1]]
    assert K.contours(np.zeros((4, 4), dtype=bool)) == []
    (c,) = K.contours(np.ones((5, 4), dtype=bool))
    assert sorted(map(tuple, c.tolist())) == [(0, 0), (0, 4), (3, 0), (3, 4)]


def test_contour_stays_on_the_border():
    rng = np.random.default_rng(3)
    for _ in range(30):
        m = rng.random((12, 12)) > 0.45
        labels = K.components(m)
        cs = K.contours(m)
        assert len(cs) == labels.max()
        for k, c in enumerate(cs, 1):
            assert all(labels[y, x] == k for x, y in c.tolist())
            ys, xs = np.nonzero(labels == k)
            assert (c.min(axis=0).tolist(), c.max(axis=0).tolist()) == ([xs.min(), ys.min()], [xs.max(), ys.max()])


def test_components_ties_and_diagonals():
    m = box((6, 9), (0, 2, 0, 2), (3, 5, 5, 7))
    labels = K.components(m)
    assert labels.max() == 2 and K.largest(labels) == 1
    assert K.components(np.eye(5, dtype=bool)).max() == 1
    assert K.largest(K.components(np.zeros((3, 3), dtype=bool))) == 0
    u = box((5, 5), (0, 5, 0, 1), (0, 5, 4, 5), (4, 5, 0, 5))
    assert K.components(u).max() == 1 and K.components(u)[0, 4] == 1


def test_border_ring_is_half_open():
    full = np.ones((10, 10), dtype=bool)
    ring = K.border_ring(full, 0.2)
    assert ring.sum() == 81 - 49 and not ring[9].any() and not ring[:, 9].any()
    # int(9 * 0.05) is 0: no ring at all. A share of a half or more is the whole box.
    assert not K.border_ring(full, 0.05).any() and K.border_ring(np.ones((41, 60), dtype=bool), 0.05).sum() == 40 * 59 - 36 * 55
    assert K.border_ring(full, 0.6).sum() == 81 and not K.border_ring(~full).any()


def plain_dilate(mask, radius, ellipse):
    out = np.zeros_like(mask)
    for y, x in zip(*np.nonzero(mask)):
        for dy in range(-radius, radius + 1):
            reach = round((radius**2 - dy**2) ** 0.5) if ellipse else radius
            if 0 <= y + dy < mask.shape[0]:
                out[y + dy, max(0, x - reach) : x + reach + 1] = True
    return out


def test_dilation_equals_the_definition():
    rng = np.random.default_rng(7)
    for radius in (0, 1, 2, 3, 9, 20):
        for shape in ((1, 1), (7, 12), (15, 4)):
            mask = rng.random(shape) > 0.8
            for ellipse in (False, True):
                assert (K.dilate(mask, radius, ellipse) == plain_dilate(mask, radius, ellipse)).all()


def test_min_max_rounds():
    assert K.min_max(np.array([[10, 11, 12, 14]], dtype=np.uint8)).tolist() == [[0, 64, 128, 255]]
    assert K.min_max(np.full((2, 2), 9, dtype=np.uint8)).tolist() == [[0, 0], [0, 0]]


def test_drawings():
    page = np.full((30, 30), 200, dtype=np.uint8)
    mask = box((30, 30), (5, 20, 5, 22))
    traced = K.overlaid(page, mask, 20.0)
    assert (traced[5, 10] == K.RED).all() and (traced[12, 12] == 200).all() and traced.shape == (30, 30, 3)
    plain = K.overlaid_plain(page, mask)
    assert plain[12, 12].tolist() == [200, 255, 200] and (plain[5, 10] == [0, 80, 255]).all()
    drawn = K.labelled(page, [np.array([[5, 5], [20, 5], [20, 20], [5, 20]])])
    assert drawn[12, 12].tolist() == [110, 200, 110] and (drawn[5, 12] == K.RED).all() and (drawn[25, 25] == 200).all()
    outer, inner = K.outer_inner(page, mask, 150, 2, 0.2)
    out = K.classified(page, mask, outer, inner, 20.0)
    assert set(map(tuple, out.reshape(-1, 3).tolist())) <= {(200, 200, 200), K.RED, K.GREEN, K.CYAN}
    assert not K.traced(np.zeros((5, 5), dtype=bool)).any()


def test_sizes_of_other_kinds():
    a = np.arange(20.0).reshape(4, 5)
    assert (K.sampled_linear(a, 4, 5) == a).all() and np.allclose(K.sampled_linear(np.full((3, 3), 7.0), 8, 2), 7)
    assert np.allclose(K.sampled_linear(np.array([[0.0, 4.0]]), 1, 4), [[0, 1, 3, 4]])
    b = a.astype(np.uint8)
    assert (K.resized_cubic(b, 4, 5) == b).all() and (K.resized_cubic(np.full((9, 9, 3), 40, dtype=np.uint8), 4, 20) == 40).all()


def test_outer_and_inner_part_the_mask():
    rng = np.random.default_rng(4)
    for _ in range(20):
        image, mask = rng.integers(0, 256, (20, 20), dtype=np.uint8), rng.random((20, 20)) > 0.6
        outer, inner = K.outer_inner(image, mask, 200, 2)
        assert ((outer | inner) == mask).all() and not (outer & inner).any()


def test_otsu_and_dark_mask():
    a = np.full((8, 8), 200, dtype=np.uint8)
    a[2:5, 2:6] = 30
    assert K.otsu(a) == 30 and (K.dark_mask(a) == box((8, 8), (2, 5, 2, 6))).all()


def test_auto_crop_of_a_page_with_margins():
    a = np.full((100, 80), 255, dtype=np.uint8)
    a[30:50, 40:60] = 0
    assert K.auto_crop(a, 5) == (25, 54, 35, 64)
    assert K.auto_crop(np.full((9, 9), 255, dtype=np.uint8)) == (0, 9, 0, 9)


def test_turns_tiles_and_sizes():
    a = np.arange(30, dtype=np.uint8).reshape(5, 6)
    assert (K.turned(a, 90)[0] == a[::-1, 0]).all() and (K.turned(K.turned(a, 270), 90) == a).all()
    t = K.tile(a, 3, 4, 4)
    assert (t[:2, :2] == a[3:, 4:]).all() and (t[2:] == 255).all()
    assert (K.resized(a, 5, 6) == a).all() and K.resized(np.full((9, 7), 40, dtype=np.uint8), 4, 3).tolist() == [[40] * 3] * 4


def test_fill_edges_and_style():
    square = np.array([[2, 2], [6, 2], [6, 6], [2, 6]])
    assert (K.filled((10, 10), [square]) == box((10, 10), (2, 7, 2, 7))).all()
    assert K.outlined((10, 10), [square]).sum() == 16
    s = K.label_styled(np.full((10, 10), 90, dtype=np.uint8), [square], 1, 1, 3, 5)
    assert s[4, 4] == 255 and s[2, 4] == 0 and s[1, 4] == 255
    assert K.dilate(box((9, 9), (4, 5, 4, 5)), 2).sum() == 25 and K.dilate(box((9, 9), (4, 5, 4, 5)), 2, True).sum() < 25


def test_modes():
    a = np.random.default_rng(1).integers(50, 200, (9, 9, 3), dtype=np.uint8)
    assert K.preprocessed(a, "norm").max() == 255 and set(np.unique(K.preprocessed(a, "bin"))) <= {0, 255}
    assert (K.preprocessed(a, "gray") == K.gray(a)).all()
    with pytest.raises(ValueError):
        K.preprocessed(a, "other")
    with pytest.raises(ValueError):
        K.gaussian_weights(4)
    assert K.blended(np.array([100.0]), np.array([200.0]), 0.55, 0.45)[0] == 145
