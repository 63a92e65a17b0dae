"""Reading landing payloads, and writing them."""
