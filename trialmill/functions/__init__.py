"""See the README for the operators in this subpackage."""
