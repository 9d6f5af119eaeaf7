"""Two texts of 1,024 letters without a space that a polynomial hash modulo 2^64 can't tell apart, whatever its base."""

A = "a"
for _ in range(10):
    A += A.translate(str.maketrans("ab", "ba"))
B = A.translate(str.maketrans("ab", "ba"))
