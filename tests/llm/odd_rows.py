"""Rows that operators must take without harm, and the driver's folders."""

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ODD_ROWS = [(1, None), (2, ""), (3, " \n\t "), (None, "a lone text"), (None, None), (4, "some words here"), (4, "some words here"), (5, "x" * 200_000), (6, "word " * 30_000), (7, "some words here")]
