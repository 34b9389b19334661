"""Part of walloom; see the README."""
