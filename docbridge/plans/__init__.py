"""The catalogue of registered queries and their expected-answer SQL."""
