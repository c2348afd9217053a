"""Tests that hold ties to NumPy's products need one similarity for equal vectors wherever they stand.
OpenBLAS' AVX-512 kernel sums the last columns of `U @ U.T` in another order; the one for AVX2 doesn't."""

import os

os.environ.setdefault("OPENBLAS_CORETYPE", "Haswell")
