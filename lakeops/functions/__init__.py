"""See the README for what lives in this folder."""
