"""Named views, ad-hoc reports and end-to-end runs built from the operators."""
