"""The market configuration: schemas put together into models, marts, checks and runs."""
