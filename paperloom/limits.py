"""What one search request returns."""

# Fixed value.
PAGE_SIZE = 25
