"""The cocoa weighing pipeline, composed from the operators."""
