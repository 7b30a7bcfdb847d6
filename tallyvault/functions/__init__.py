"""Column expressions: fingerprints, column parsers, currency conversion."""
