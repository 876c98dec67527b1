"""Views, metrics and questions composed from operators."""
